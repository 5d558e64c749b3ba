"""Column expressions: parsing, identity and the readiness rule."""
