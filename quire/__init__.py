"""Spark-native structuring of page-level documents."""
