"""Spark-first analytics over text records."""
