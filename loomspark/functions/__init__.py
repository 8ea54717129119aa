"""Column expressions and small numerical routines."""
