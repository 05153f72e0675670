"""Incremental landing as a Structured Streaming job (available-now trigger)."""
