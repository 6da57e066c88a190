"""Whole jobs: operators put together from the raw table to the scores."""
