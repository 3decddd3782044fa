"""Column-expression building blocks."""
