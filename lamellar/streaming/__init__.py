"""Streaming views of run telemetry."""
