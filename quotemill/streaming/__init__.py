"""Ingest jobs, micro-batch sinks and event-time operators."""
