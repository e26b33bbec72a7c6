"""Retail analytics on Spark: daily JSON to marts, table operators and data checks."""
