"""Continuous forms of the history operators."""
