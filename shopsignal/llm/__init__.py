"""Operators for large training-data pipelines (texts in, decisions / tokens / files out)."""
