"""Operators: QA gate, summaries, drift, breaker and incidents."""
