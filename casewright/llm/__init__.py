"""Operators of a training-data pipeline: packing, deduplication, mixing, filtering, extraction, search and scanning.

Nothing else in the library imports this package; ``queries`` holds its registered queries and their SQL.
"""
