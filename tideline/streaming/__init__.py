"""Streaming sinks: the plain table sink and per-batch writers."""
