"""Operators of a training-data pipeline.

Nothing else in the library imports this package: it can be deleted without
touching the clickstream operators. ``queries`` holds the registered queries.
"""
