"""Fleet condition analytics on Spark DataFrames."""
