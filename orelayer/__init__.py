"""Layered (bronze, silver, gold) data work on Spark DataFrames."""

__version__ = "0.1.0"
