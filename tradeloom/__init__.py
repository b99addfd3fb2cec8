"""Spark-native analytics for bilateral trade records."""
