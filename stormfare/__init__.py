"""Trip and hourly-weather analytics on Spark DataFrames."""
