"""Operators: plain functions from DataFrames to DataFrames, the same in batch and in a micro-batch."""
