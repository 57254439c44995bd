"""Operators of a training-data pipeline: packing, deduplication, classifiers, filters, token files.

Nothing else in the library imports this subpackage; ``queries`` holds its registered queries.
"""
