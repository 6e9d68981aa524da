"""Duplicate detection for titled records, planned by Spark."""
