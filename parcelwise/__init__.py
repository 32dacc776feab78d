"""Spark-native tabular preparation, profiling, model comparison and scoring."""
