"""Paperloom: document and assessment analytics on Spark DataFrames."""
