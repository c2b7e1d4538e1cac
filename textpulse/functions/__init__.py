"""Column expressions: text cleaning, lexicon scoring and message fields."""
