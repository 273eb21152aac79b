"""Tidemark: change events in, trustworthy star schema out, on Spark DataFrames."""

__version__ = "0.1.0"
