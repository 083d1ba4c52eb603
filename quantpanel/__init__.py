"""Portfolio panel analytics on Spark DataFrames."""
