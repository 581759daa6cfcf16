"""A source that falls silent must not stop the windows.

The watermark of the union is the smallest of its sources' (W5), so one silent source holds it
back for all.  Each source therefore also reads a folder of heartbeat rows, which pass its
watermark and nothing else.  ``IdleSources`` watches the query's progress: a source that had no
valid row for ``idle_s`` seconds, while another had some, gets a heartbeat at the newest event
time of the active sources, so the watermark becomes that of the active ones alone.  When all
are silent nothing moves.

Rule for rows that come back: the watermark never goes back, so rows of a returning source count
in the windows that are still open and are late, and dropped, for the others, like any late row.
Its first valid row ends its idleness.  A restarted job starts its clocks anew.
"""

from __future__ import annotations

import json
import time
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from clickrate.session import ensure_dir, write_small_file

HEARTBEAT_SCHEMA = "heartbeat_ms long"
IDLE_S = 30.0
_HEARTBEAT = "_heartbeat"


def heartbeat_stream(spark: SparkSession, folder: str) -> DataFrame:
    return spark.readStream.schema(HEARTBEAT_SCHEMA).json(ensure_dir(spark, folder))


def with_heartbeats(events: DataFrame, heartbeats: DataFrame, delay: str) -> DataFrame:
    """``events`` (with event_time) behind one watermark with their heartbeats, which then go."""
    beats = heartbeats.select(F.timestamp_millis("heartbeat_ms").alias("event_time"), F.lit(True).alias(_HEARTBEAT),
                              F.lit(_HEARTBEAT).alias("product_id"))  # a product, or the filter on it would drop them below the watermark
    both = events.withColumn(_HEARTBEAT, F.lit(False)).unionByName(beats, allowMissingColumns=True).withWatermark("event_time", delay)
    # Names the event time, so that the optimizer leaves the filter above the watermark.
    return both.filter(~F.col(_HEARTBEAT) | F.col("event_time").isNull()).drop(_HEARTBEAT)


class IdleSources:
    """Writes heartbeats; ``folders`` maps each source's observed name to its heartbeat folder."""

    def __init__(self, spark: SparkSession, folders: dict[str, str], idle_s: float = IDLE_S, clock: Callable[[], float] = time.time):
        self.spark, self.folders, self.idle_s, self.clock = spark, folders, idle_s, clock
        self.active = dict.fromkeys(folders, clock())
        self.newest: dict[str, int] = {}
        self.written: dict[str, int] = {}

    def record(self, batch: dict) -> None:
        """One micro-batch, as ``progress.batch_record`` gives it."""
        now = self.clock()
        for source, seen in batch["observed"].items():
            if source in self.folders and seen["rows"]:
                self.active[source] = now
                self.newest[source] = max(self.newest.get(source, seen["newest_ms"]), seen["newest_ms"])
        idle = [s for s in self.folders if now - self.active[s] >= self.idle_s]
        awake = [self.newest[s] for s in self.folders if s not in idle and s in self.newest]
        if not awake:
            return
        beat = min(awake)  # the smallest: what the watermark would be without the idle ones
        for source in idle:
            if beat > max(self.newest.get(source, beat - 1), self.written.get(source, beat - 1)):
                write_small_file(self.spark, f"{self.folders[source]}/beat-{beat:020d}.json", json.dumps({"heartbeat_ms": beat}) + "\n")
                self.written[source] = beat
