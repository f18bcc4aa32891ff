"""Spark-native analytics for news-style article streams."""
