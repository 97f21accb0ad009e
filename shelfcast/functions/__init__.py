"""Column expressions and condition terms (built-in Spark functions only)."""
