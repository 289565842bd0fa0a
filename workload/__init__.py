"""Named queries of the driver contract: inputs, Spark side and SQL side."""
