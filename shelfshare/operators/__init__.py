"""Operators from DataFrames to a DataFrame; none of them runs a job."""
