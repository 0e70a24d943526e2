"""A booking warehouse expressed as Spark DataFrame jobs."""
