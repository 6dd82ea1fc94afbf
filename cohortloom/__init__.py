"""Spark-native clinical risk-screening analytics."""
