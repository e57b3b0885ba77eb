"""Relational building blocks: functions from DataFrames to DataFrames."""
