"""Spark-native batch warehouse for museum-collection exports."""
