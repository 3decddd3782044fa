"""Composed plans: the full pipeline and the query catalog."""
