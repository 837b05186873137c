"""Marketing and sales analytics as Spark DataFrame jobs."""
