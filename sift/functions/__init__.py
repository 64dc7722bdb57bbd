"""Column expressions: text cleaning, n-grams, label flags, paging."""
