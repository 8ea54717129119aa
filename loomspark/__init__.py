"""Spark-native batch-table and training-dataset engine."""
