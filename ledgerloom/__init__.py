"""Financial-statement analytics on Spark DataFrames."""
