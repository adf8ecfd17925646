"""Structured Streaming sources, sinks and stateful jobs."""
