"""Service-request analytics as Spark jobs."""
