"""Snapshots in, strictly backward-looking features out, on plain Spark."""
