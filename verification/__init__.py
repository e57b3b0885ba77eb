"""Inputs, queries and comparison SQL that check the warehouse on the given tables."""
