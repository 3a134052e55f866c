"""Column expressions: canonical URLs, normalised text, vectors, rounding."""
