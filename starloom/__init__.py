"""Spark jobs for a commercial star schema with free-text feedback."""
