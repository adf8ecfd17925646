"""Column expressions and Python functions."""
