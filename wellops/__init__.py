"""Well-operations analytics as plain Spark jobs."""
