"""Weighted-tag similarity, catalogue building and title search as Spark DataFrame plans."""
