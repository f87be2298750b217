"""Order and courier analytics as Spark DataFrame jobs."""
