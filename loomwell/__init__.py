"""Reusable Spark operators, streaming jobs and whole jobs over DataFrames."""
