"""Operators on text and matches for preparing training data. Nothing outside this package imports it."""
