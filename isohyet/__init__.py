"""Meteorological time series on Spark DataFrames."""
