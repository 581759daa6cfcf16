"""Composed jobs (batch pipeline, registered queries)."""
