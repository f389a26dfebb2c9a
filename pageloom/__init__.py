"""Spark-native analytics over transcribed, page-based archival text."""
