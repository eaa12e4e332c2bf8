"""Hybrid retrieval, enrichment and ranking jobs over Spark DataFrames."""
