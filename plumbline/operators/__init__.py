"""The operators: each takes DataFrames and gives DataFrames."""
