"""lexmill: preparing and profiling text corpora with Spark DataFrames."""
