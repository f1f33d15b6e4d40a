"""Domain-name observation analytics as Spark jobs."""
