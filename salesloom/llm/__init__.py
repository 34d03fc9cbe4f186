"""Operators for preparing training text, each on whole corpora."""
