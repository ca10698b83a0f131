"""Operators that prepare documents for model training; nothing outside this package imports it."""
