"""Loan data quality and credit scoring as PySpark DataFrame jobs."""
