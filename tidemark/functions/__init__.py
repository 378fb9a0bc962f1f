"""Column functions. Each maps columns to columns and stays inside generated code."""
