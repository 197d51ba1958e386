"""The marts. Every function takes DataFrames and scalars and returns a DataFrame."""
