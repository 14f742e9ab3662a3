"""Risk-classifier tables on Spark: clean, split, train, compare, search, promote."""
