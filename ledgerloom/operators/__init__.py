"""Ledger operators: functions from DataFrames to DataFrames."""
