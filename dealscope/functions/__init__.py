"""Column expressions: parsing, calendar and classification."""
