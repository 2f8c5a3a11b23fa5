"""Column expressions: text, identifiers and dates."""
