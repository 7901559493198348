"""Column expression helpers."""
