"""Datasets as functions from DataFrames to a DataFrame."""
