"""Operators for building training data: each turns DataFrames into DataFrames."""
