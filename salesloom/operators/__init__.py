"""Reusable relational building blocks: filters, joins, top-k, listings, validation, merge, sketch."""
