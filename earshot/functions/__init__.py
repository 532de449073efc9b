"""Column expressions: text, numbers, codes, projections and geometry measures."""
