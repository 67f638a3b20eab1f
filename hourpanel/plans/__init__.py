"""Composed stages, and the registered queries on the given tables."""
