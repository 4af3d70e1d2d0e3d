"""Column expressions: each function takes columns and returns columns; none needs a Python worker."""
