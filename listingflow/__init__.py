"""Classified-listing analytics as Spark DataFrame, SQL and ML plans."""
