"""Column functions: text, n-grams, lexicon matching, fuzzy ratios."""
