"""Corpus-curation operators on Spark DataFrames."""
