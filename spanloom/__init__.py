"""Spark-native engine for span-anchored document evidence."""
