"""The models, one module per domain. Each is a function from DataFrames to a DataFrame."""
