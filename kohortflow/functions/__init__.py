"""Column expressions and code lists."""
