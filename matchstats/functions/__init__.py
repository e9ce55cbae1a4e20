"""Column expressions: text, ratios and season lists."""
