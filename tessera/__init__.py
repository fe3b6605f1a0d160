"""Spark-first point-in-time market analytics."""
