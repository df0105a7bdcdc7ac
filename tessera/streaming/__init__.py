"""Structured Streaming: stateless scoring and windowed monitoring."""
