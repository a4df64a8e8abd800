"""Column expressions: ratios, dates, text and nested values."""
