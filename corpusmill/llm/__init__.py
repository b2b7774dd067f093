"""Operators for language-model training data. Nothing outside this folder imports it."""
