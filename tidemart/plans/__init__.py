"""Layers of the lakehouse as functions from DataFrames to DataFrames."""
