"""Operators for building training corpora: one module each, queries and SQL in ``registry``."""
