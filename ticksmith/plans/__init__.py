"""Composed jobs, storage layout and the query catalogue."""
