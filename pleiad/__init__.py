"""Nested event analytics on PySpark."""
