"""Sinks: stored tables, versioned upserts, incremental rollups, dead letters."""
