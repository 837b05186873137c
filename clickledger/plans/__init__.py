"""The warehouse jobs, each a function from DataFrames to a lazy DataFrame."""
