"""Column builders: text cleaning, personal data, quality, similarity."""
