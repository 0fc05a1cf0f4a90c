"""Operators for preparing training data. Nothing else in this library imports them."""
