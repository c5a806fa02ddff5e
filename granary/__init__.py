"""Granary: building, checking, enriching and publishing text corpora with Spark DataFrames."""
