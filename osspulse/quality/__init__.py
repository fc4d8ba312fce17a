"""Data-quality checks."""
