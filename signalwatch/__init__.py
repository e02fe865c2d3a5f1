"""Spark-native analytics over streams of health and environment events."""
