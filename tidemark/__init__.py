"""Analytics and ingestion jobs on Spark DataFrames."""
