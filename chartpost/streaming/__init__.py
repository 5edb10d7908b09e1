"""Structured Streaming from the queue to the ready table."""
