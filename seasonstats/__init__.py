"""Point-in-time competition analytics on Spark DataFrames."""
