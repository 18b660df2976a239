"""Ingestion analytics on Spark DataFrames: incremental reads, change application, shaping, reports."""
