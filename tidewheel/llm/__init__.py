"""Operators that prepare text, pages and vectors for training; nothing else in the library imports them."""
