"""Readers of landed snapshots and writers of review files."""
