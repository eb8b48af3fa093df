"""Directory analytics on Spark: page stores and organisation lists into clean contact tables."""
