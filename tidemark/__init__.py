"""Time-series features, targets, events and datasets as lazy Spark plans."""
