"""Scoring of repayments as they arrive."""
