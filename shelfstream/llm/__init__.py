"""Operators for preparing training text, and the named queries that run them over whole tables."""
