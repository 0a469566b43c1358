"""Server-log and change-feed analytics as Spark DataFrame jobs."""
