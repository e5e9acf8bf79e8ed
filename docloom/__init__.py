"""Spark-native document ETL and retrieval."""
