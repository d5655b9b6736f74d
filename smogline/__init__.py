"""Station-based air-quality readings on Spark DataFrames and Structured Streaming."""
