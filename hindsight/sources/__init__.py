"""Landing zone, bronze ingestion, versioned tables and extracts."""
