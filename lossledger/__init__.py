"""Insurance cost analytics on Spark: DataFrame operators, no engine of its own."""
