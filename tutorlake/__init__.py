"""Batch warehousing and streaming analytics for an online-learning business, on PySpark."""
