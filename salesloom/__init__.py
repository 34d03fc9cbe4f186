"""Retail sales analytics expressed with Spark DataFrames, SQL functions and Structured Streaming."""
