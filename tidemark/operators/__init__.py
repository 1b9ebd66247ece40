"""Table operators: DataFrames in, DataFrames out, lazy unless said otherwise."""
