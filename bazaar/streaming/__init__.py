"""Structured Streaming form of the status-event feed."""
