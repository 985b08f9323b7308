"""Operators for preparing training text; no other part of the library imports them."""
