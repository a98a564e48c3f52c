"""Spark-native document analytics and retrieval."""
