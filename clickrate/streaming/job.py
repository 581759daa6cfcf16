"""The streaming CTR job (S1-S3/S5 → parse → W1/W2 → U1 → W3/W4 → A1-A3 → sinks).

Column logic is shared with the batch job.  Per source: decode, keep valid
events, event time, watermark.  The watermark delay is out-of-orderness +
allowed lateness (5 s + 5 s by default): with the session's
``statefulOperator.allowMultiple=false`` a window stays open until the
slowest source's max event time reaches window_end + delay, which is the
reference's lateness bound to the millisecond; later rows are dropped and
counted in ``numRowsDroppedByWatermark``.

Output modes: ``update`` (default) emits a window's running row in every
micro-batch that changes it, and the K2 tables keep the last version;
``append`` emits one final row per window after it closes.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from clickrate.operators.parse import dead_letters, parse_payloads, valid_events
from clickrate.operators.union import union_events
from clickrate.operators.window_agg import ctr_results, window_counts, with_event_time
from clickrate.session import in_state_tasks, state_partitions
from clickrate.sinks.dlq import start_dlq_stream
from clickrate.sinks.incremental import IncrementalTables
from clickrate.sources.events_adapter import CLICK_SOURCE, IMPRESSION_SOURCE
from clickrate.streaming.idle import with_heartbeats


@dataclass(frozen=True)
class WindowSettings:
    """The job's time parameters (seconds)."""
    window_s: int = 10
    out_of_orderness_s: int = 5
    allowed_lateness_s: int = 5

    @property
    def window(self) -> str:
        return f"{self.window_s} seconds"

    @property
    def watermark_delay(self) -> str:
        return f"{self.out_of_orderness_s + self.allowed_lateness_s} seconds"


def watermarked_events(raw: DataFrame, settings: WindowSettings = WindowSettings(), observed_as: str | None = None,
                       heartbeats: DataFrame | None = None) -> DataFrame:
    """W1 + W2 for one source: valid events with a bounded-delay watermark.  ``observed_as``
    reports each batch's rows and newest event time under that name in the query's progress.
    ``heartbeats`` (see ``idle``) only move the watermark."""
    events = with_event_time(valid_events(parse_payloads(raw)))
    if observed_as:
        events = events.observe(observed_as, F.count(F.lit(1)).alias("rows"), F.max("timestamp").alias("newest_ms"))
    if heartbeats is None:
        return events.withWatermark("event_time", settings.watermark_delay)
    return with_heartbeats(events, heartbeats, settings.watermark_delay)


def ctr_stream(impressions_raw: DataFrame, clicks_raw: DataFrame,
               settings: WindowSettings = WindowSettings(), agg_exprs: Sequence[Column] | None = None,
               result_fn: Callable[[DataFrame], DataFrame] | None = None,
               heartbeats: dict[str, DataFrame] | None = None) -> DataFrame:
    """U1 of both watermarked sources (min watermark), windowed counts, CTR.  ``agg_exprs`` and
    ``result_fn`` are the extension points (aggregate, window function), as in ``compute_ctr``;
    ``heartbeats`` has the heartbeat rows of sources that may fall silent."""
    beats = heartbeats or {}
    events = union_events(*(watermarked_events(raw, settings, name, beats.get(name))
                            for name, raw in ((IMPRESSION_SOURCE, impressions_raw), (CLICK_SOURCE, clicks_raw))))
    return (result_fn or ctr_results)(window_counts(events, settings.window, agg_exprs))


def dlq_stream(*raws: DataFrame) -> DataFrame:
    """F2 failure side of every source, as one stream."""
    out = None
    for raw in raws:
        d = dead_letters(parse_payloads(raw))
        out = d if out is None else out.unionByName(d)
    return out


def start_ctr_query(results: DataFrame, tables: IncrementalTables, checkpoint: str,
                    output_mode: str = "update", trigger: dict | None = None,
                    query_name: str | None = None, also: Callable[[DataFrame], None] | None = None):
    """K1/K2/K4/K5 through ``foreachBatch``; the query checkpoint holds the
    source offsets, watermark and window state (W7, W8).  ``also`` gets every
    batch's rows too, computed once for both."""
    setting = "spark.sql.streaming.statefulOperator.allowMultiple"
    if results.sparkSession.conf.get(setting, "true") != "false":
        raise ValueError(f"{setting} must be false: else the lateness bound is one batch late")

    def apply(df: DataFrame, batch_id: int) -> None:
        df = in_state_tasks(df)
        if also is None:
            tables.apply_batch(df, batch_id)
            return
        df = df.persist()
        try:
            tables.apply_batch(df, batch_id)
            also(df)
        finally:
            df.unpersist()

    writer = results.writeStream.outputMode(output_mode).option("checkpointLocation", checkpoint).foreachBatch(apply)
    if query_name:
        writer = writer.queryName(query_name)
    if trigger:
        writer = writer.trigger(**trigger)
    with state_partitions(results.sparkSession):
        return writer.start()


def start_dlq_query(impressions_raw: DataFrame, clicks_raw: DataFrame, path: str, checkpoint: str,
                    trigger: dict | None = None):
    """K6."""
    return start_dlq_stream(dlq_stream(impressions_raw, clicks_raw), path, checkpoint, trigger)


def progress_dropped_rows(query) -> int:
    """Groups of late rows dropped in the micro-batches whose progress the query still holds: Spark
    counts them after its partial aggregation.  ``progress.drops_by_batch`` has the exact rows (W6)."""
    return sum(op.get("numRowsDroppedByWatermark", 0) for p in query.recentProgress for op in p.get("stateOperators", []))


__all__ = ["WindowSettings", "ctr_stream", "dlq_stream", "start_ctr_query", "start_dlq_query",
           "watermarked_events", "progress_dropped_rows", "F"]
