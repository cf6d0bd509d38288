"""Operators of a training-data pipeline, each with a query in ``queries.py``."""
