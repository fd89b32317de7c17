"""Structured Streaming forms: state processors, sinks, running jobs."""
