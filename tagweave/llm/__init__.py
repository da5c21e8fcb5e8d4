"""Operators for building training data: rules, classifiers, near-duplicates, mixing, formatting."""
