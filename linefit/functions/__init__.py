"""Column expressions: text fields and numeric arrays."""
