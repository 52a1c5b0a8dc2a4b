"""Column expressions: text, dates, JSON, nested values, vectors."""
