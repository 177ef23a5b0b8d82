"""Column expressions: text fields, pixel arithmetic, aggregate statistics."""
