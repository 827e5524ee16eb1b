"""Load jobs, checks and reports, each a function from DataFrames to a DataFrame."""
