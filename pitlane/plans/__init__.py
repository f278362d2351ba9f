"""Marts, views and reports: DataFrames in, DataFrame out; only `job` writes."""
