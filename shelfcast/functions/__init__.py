"""Column expressions: category labels, accuracy bins, effect-day names."""
