"""Column-level vocabulary."""
