"""Battery-fleet analytics on Spark DataFrames."""
