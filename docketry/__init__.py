"""Document ingestion and retrieval indexes as Spark jobs."""
