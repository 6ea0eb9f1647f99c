"""Spark-first interval, variant and index analytics."""
