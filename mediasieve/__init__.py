"""Spark-native curation of labelled media datasets."""
