"""Spark-native curation and evaluation of before/after code pairs."""
