"""Ledger analytics on Spark DataFrames."""
