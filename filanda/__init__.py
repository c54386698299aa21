"""Filanda: document analytics on Spark DataFrames."""
