"""Analytics for intraday market bars on Spark DataFrames."""
