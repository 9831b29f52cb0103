"""Column expressions: text, geometry, values, headers and formulas."""
