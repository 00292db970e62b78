"""The jobs. Each takes DataFrames and keyword options and returns DataFrames."""
