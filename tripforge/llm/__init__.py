"""Operators for large-scale training-data pipelines (see each module)."""
