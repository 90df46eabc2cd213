"""Portfolio and market-data engine on Spark DataFrames."""
