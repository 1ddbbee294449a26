"""Trade-event analytics on Spark: one set of DataFrame operators for batch and streams."""
