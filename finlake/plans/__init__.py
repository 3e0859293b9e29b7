"""Pipelines (the three batch jobs) and the query catalogue."""
