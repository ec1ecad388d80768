"""Genome-to-genome comparison tables as Spark DataFrames."""
