"""Text corpus preparation, corruption and evaluation as Spark DataFrame jobs."""
