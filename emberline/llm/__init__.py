"""Operators on document tables for training-data pipelines; nothing else in the package imports them."""
