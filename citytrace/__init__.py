"""Origin-destination trip analytics written as Spark DataFrame jobs."""
