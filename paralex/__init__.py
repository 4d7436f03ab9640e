"""Spark-native preparation of multilingual parallel corpora."""
