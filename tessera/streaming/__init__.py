"""Structured Streaming forms; the batch operators' semantics on unbounded input."""
