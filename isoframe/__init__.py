"""Transcript-annotation analytics on Spark DataFrames."""
