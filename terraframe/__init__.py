"""Crop-mapping and pixel analytics on Spark DataFrames."""
