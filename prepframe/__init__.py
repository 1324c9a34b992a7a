"""Table preparation and profiling on Spark DataFrames."""
