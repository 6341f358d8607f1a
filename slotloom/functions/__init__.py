"""Column expressions: text, context, one-hot and score formulas."""
