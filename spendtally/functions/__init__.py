"""Column expressions: text, keys, dates, status and JSON."""
