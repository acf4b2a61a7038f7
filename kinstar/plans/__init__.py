"""Composed plans: reports, the incremental run, and the query registry."""
