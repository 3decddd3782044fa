"""Structured Streaming variants of the gate and the stateful drift/breaker."""
