"""Spark-native consolidation of structural-variant calls."""
