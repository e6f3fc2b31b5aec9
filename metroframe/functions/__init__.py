"""Column expressions built only from Spark's built-in functions (codegen'd)."""
