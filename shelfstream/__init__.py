"""Retail clickstream, stock and sales analytics on Spark DataFrames."""
