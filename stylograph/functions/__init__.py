"""Column expressions: patterns, text cleaning, style features, hashing, statistics."""
