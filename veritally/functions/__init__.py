"""Column expressions: text, hashing, scores and ratios."""
