"""Leafmill: document collections as queryable tables, on Spark DataFrames."""
