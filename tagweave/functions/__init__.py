"""Column expressions: text normalization, list and feature handling, parameters."""
