"""Operators that prepare text collections for training. Nothing else in the library imports them."""
