"""Lodestack: catalog, corpus and training-data queries expressed as Spark DataFrames."""

__version__ = "0.1.0"
