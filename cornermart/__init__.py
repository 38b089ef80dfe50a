"""Retail and subscription analytics on Spark DataFrames: ingest, clean, aggregate, check."""
