"""Spark-native cross-catalog comparison engine."""
