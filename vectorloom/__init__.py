"""Feature vectors and training sequences from raw tables, on Spark DataFrames."""
