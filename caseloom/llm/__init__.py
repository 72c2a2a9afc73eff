"""Operators for large text collections that train language models. Nothing else in the library imports this."""
