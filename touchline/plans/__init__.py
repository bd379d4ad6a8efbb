"""Registered queries: the operators composed over the given tables."""
