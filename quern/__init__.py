"""Spark-native operators for curating documents into training data."""
