"""Corpus preparation and run analysis on Spark DataFrames."""
