"""Windowed streams, the batch ledger behind the result tables, and running several queries."""
