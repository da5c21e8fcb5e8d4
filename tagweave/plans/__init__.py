"""Whole plans: building the catalogue, and binding it to star-schema tables."""
