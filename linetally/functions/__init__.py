"""Column expressions (no UDFs)."""
