"""Spark-native click-through-rate analytics.

Raw impression / click payloads are parsed into events (invalid ones go to a
dead-letter table), unioned, counted per product in event-time tumbling
windows and turned into CTR rows.  Stored result tables, mergeable rollups and
the read-side queries sit on top.  Batch and Structured Streaming use the same
column functions, so a replayed stream and a batch run give the same rows.
"""

from clickrate.session import configure, get_session, shared_dir

__all__ = ["configure", "get_session", "shared_dir"]
