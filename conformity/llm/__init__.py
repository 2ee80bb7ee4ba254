"""Operators for preparing language-model training data (kept apart from the rest of the library)."""
