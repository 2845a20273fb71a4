"""Incremental web-corpus building on Spark DataFrames."""
