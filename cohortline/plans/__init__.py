"""Whole jobs: cleaning by specification, comparing models, tuned runs."""
