"""Spark-native curation and analytics of text and code corpora."""
