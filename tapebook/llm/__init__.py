"""Operators of a training-data pipeline over the ``documents`` family of tables."""
