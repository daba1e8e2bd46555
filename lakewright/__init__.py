"""lakewright: review analytics on Spark DataFrames."""
