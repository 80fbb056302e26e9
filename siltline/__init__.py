"""siltline: layered analytics on PySpark.

Change-log ingestion, keyed merges, metric tables, data checks and table shaping, all written as
functions from DataFrames to DataFrames.
"""
