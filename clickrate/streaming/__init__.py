"""Structured Streaming job, replay driver and the exact fire log."""
