"""Rail mobility warehouse and analytics as Spark DataFrame jobs."""
