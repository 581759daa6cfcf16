"""The whole job in one call: two sources, parse, windows, tables, dead letters.

A source is a dict: ``{"topic": ..., "bootstrap_servers": ..., "group_id": ...}`` with further
arguments of ``kafka_reader``, or ``{"path": ...}`` for a folder of JSON line files.  Both
queries start with a 60 s trigger unless another one is given, and restart from their
checkpoints under ``root``.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, SparkSession

from clickrate.session import configure
from clickrate.sinks.incremental import IncrementalTables
from clickrate.sinks.jdbc import append_jdbc
from clickrate.sources.events_adapter import CLICK_SOURCE, IMPRESSION_SOURCE
from clickrate.sources.files import stream_payload_files
from clickrate.sources.kafka import stream_topic
from clickrate.streaming.idle import IdleSources, heartbeat_stream
from clickrate.streaming.job import WindowSettings, ctr_stream, start_ctr_query, start_dlq_query
from clickrate.streaming.progress import ProgressListener, ProgressLog

TRIGGER = {"processingTime": "60 seconds"}


def open_source(spark: SparkSession, source: dict, name: str) -> DataFrame:
    """S1-S3 or S5: raw records of one source."""
    rest = {k: v for k, v in source.items() if k != "path"}
    return stream_payload_files(spark, source["path"], name, **rest) if "path" in source else stream_topic(spark, source=name, **source)


def run_job(spark: SparkSession, impressions: dict, clicks: dict, root: str,
            settings: WindowSettings = WindowSettings(), output_mode: str = "update",
            trigger: dict | None = None, jdbc: dict[str, str] | None = None,
            agg_exprs: Sequence[Column] | None = None,
            result_fn: Callable[[DataFrame], DataFrame] | None = None,
            idle_s: float | None = None) -> tuple[IncrementalTables, list]:
    """The tables under ``root`` and the two started queries (results, dead letters).

    ``jdbc`` (``jdbc_options``) also appends every emitted row to a database table.
    ``agg_exprs`` and ``result_fn`` replace the aggregate and the window function; the
    result needs the sink's six columns.  Every micro-batch is kept in the table ``progress``
    (W6); with ``idle_s`` a source that is silent that long no longer holds the windows (V15)."""
    configure(spark)
    trigger = trigger or TRIGGER
    imp_raw, clk_raw = open_source(spark, impressions, IMPRESSION_SOURCE), open_source(spark, clicks, CLICK_SOURCE)
    tables = IncrementalTables(spark, f"{root}/tables")
    handlers, beats = [ProgressLog(spark, f"{root}/progress").record], None
    if idle_s is not None:
        folders = {s: f"{root}/heartbeats/{s}" for s in (IMPRESSION_SOURCE, CLICK_SOURCE)}
        beats = {s: heartbeat_stream(spark, f) for s, f in folders.items()}
        handlers.append(IdleSources(spark, folders, idle_s).record)
    spark.streams.addListener(ProgressListener(*handlers, query_name="ctr"))
    results = ctr_stream(imp_raw, clk_raw, settings, agg_exprs, result_fn, beats)
    also = (lambda rows: append_jdbc(rows, jdbc)) if jdbc else None
    return tables, [start_ctr_query(results, tables, f"{root}/checkpoints/ctr", output_mode, trigger, "ctr", also),
                    start_dlq_query(imp_raw, clk_raw, f"{root}/dlq", f"{root}/checkpoints/dlq", trigger)]
