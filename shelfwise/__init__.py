"""Catalog rating and recommendation on Spark DataFrames."""
