"""Spatial feature-matrix analytics on Spark DataFrames."""
