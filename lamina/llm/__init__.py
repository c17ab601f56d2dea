"""Operators for text that feeds or comes from language models. Nothing outside this package imports it."""
