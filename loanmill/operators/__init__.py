"""Table operators: DataFrames in, DataFrames out, no action run."""
