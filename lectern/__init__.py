"""Keyed-text analytics and corpus preparation on PySpark."""
