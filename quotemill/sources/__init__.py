"""Feeds, topic readers and message encoding."""
