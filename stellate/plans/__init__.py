"""The models, checks and reports, each a function from DataFrames to a lazy DataFrame."""
