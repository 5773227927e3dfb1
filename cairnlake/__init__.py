"""Spark-native analytics over cultural-heritage knowledge graphs."""
