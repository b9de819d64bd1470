"""Market-quote analytics as Spark DataFrame, streaming and MLlib jobs."""
