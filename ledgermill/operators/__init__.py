"""Transforms: DataFrames in, DataFrame out, no action inside."""
