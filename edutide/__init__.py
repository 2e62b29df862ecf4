"""Spark-native analytics over learning telemetry: DataFrames in, DataFrames out."""
