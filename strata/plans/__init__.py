"""Composed plans: the medallion pipeline, publishing, and the registered queries."""
