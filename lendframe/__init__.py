"""Loan-application analytics expressed as Spark DataFrame, ML and streaming jobs."""
