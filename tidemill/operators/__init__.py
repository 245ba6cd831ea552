"""The shop's operators: DataFrames in, DataFrames out, nothing collected."""
