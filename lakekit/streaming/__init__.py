"""Structured Streaming entry points (arrival-driven incremental loading)."""
