"""Spark-native curation and certification of text and speech datasets."""
