"""Replays of the driver's ``events`` table as two file streams.

The payloads are staged once, by delivery step and source: ``steps``
consecutive event-time slices.  Step by step they are put into one folder per
source and the stream runs with ``trigger(availableNow=True)`` from its
checkpoint, so every slice is one micro-batch and every step also exercises a
restart from the checkpoint.

With slices in time order no row is late and the final table equals the batch
job's result.  ``held_every`` delivers each row whose event_id it divides one
step later than the others, so rows come late; ``fresh_from`` lets the job go
on with a new checkpoint and new folders from that step.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from clickrate.session import configure, ensure_dir, in_state_tasks, shared_dir, state_partitions
from clickrate.sinks.incremental import IncrementalTables
from clickrate.sources.events_adapter import (
    CLICK_SOURCE, IMPRESSION_SOURCE, arrival_records, load_events, payload_json,
)
from clickrate.sources.files import stream_payload_files
from clickrate.streaming.fire_log import fire_log_stream
from clickrate.streaming.health import start_status_query, status_stream
from clickrate.streaming.job import WindowSettings, ctr_stream, start_ctr_query, start_dlq_query
from clickrate.streaming.progress import ProgressListener, ProgressLog

AVAILABLE_NOW = {"availableNow": True}


@dataclass
class ReplayResult:
    tables: IncrementalTables
    dlq_path: str
    batches: int
    progress: ProgressLog


def step_width(payloads: DataFrame, steps: int) -> tuple[int, int]:
    """Start of the first slice and width of each, in ms."""
    lo, hi = payloads.agg(F.min("ts_ms"), F.max("ts_ms")).first()
    return lo, (hi - lo + steps) // steps


def stage_steps(spark: SparkSession, sf_dir: str, path: str, steps: int, product_buckets: int | None, held_every: int | None) -> str:
    """Payloads by delivery step and source, written to ``path``."""
    payloads = payload_json(load_events(spark, sf_dir), product_buckets).select("event_id", "source", "ts_ms", "json")
    lo, width = step_width(payloads, steps)
    step = F.expr(f"least((ts_ms - {lo}L) div {width}L, {steps - 1}L)")
    if held_every:
        step = step + F.when(F.col("event_id") % held_every == 0, 1).otherwise(0)
    payloads.select("source", "json", step.cast("int").alias("step")).write.partitionBy("step", "source").parquet(path)
    return path


def deliver(spark: SparkSession, staged: str, step: int, folders: dict[str, str]) -> None:
    """Put one step's payloads into the sources' folders."""
    part = spark.read.schema("json string, step int, source string").parquet(staged).filter(F.col("step") == step)
    for source, folder in folders.items():
        part.filter(F.col("source") == source).select("json").write.mode("append").text(folder)


def replay_events(spark: SparkSession, sf_dir: str, steps: int = 4,
                  settings: WindowSettings = WindowSettings(), output_mode: str = "update",
                  with_dlq: bool = True, product_buckets: int | None = None,
                  held_every: int | None = None, fresh_from: int | None = None) -> ReplayResult:
    configure(spark)
    root = shared_dir(spark, "replay")
    staged = stage_steps(spark, sf_dir, f"{root}/staged", steps, product_buckets, held_every)

    tables = IncrementalTables(spark, f"{root}/tables")
    dlq_path = f"{root}/dlq"
    log = ProgressLog(spark, f"{root}/progress")
    listener = ProgressListener(log.record)
    spark.streams.addListener(listener)
    batches, run = 0, None
    for i in range(steps + bool(held_every)):
        if run is None or i == fresh_from:
            run = f"run{i}"
            folders = {s: ensure_dir(spark, f"{root}/{run}/in/{s}") for s in (IMPRESSION_SOURCE, CLICK_SOURCE)}
            imp_raw, clk_raw = (stream_payload_files(spark, path, s) for s, path in folders.items())
            results = ctr_stream(imp_raw, clk_raw, settings)
        deliver(spark, staged, i, folders)
        q = start_ctr_query(results, tables, f"{root}/{run}/chk/ctr", output_mode, AVAILABLE_NOW)
        q.awaitTermination()
        listener.wait(q)
        batches += len([p for p in q.recentProgress if p.get("numInputRows", 0) > 0])
        if with_dlq:
            # a second read and decode of both sources: the dead letters are their own query
            start_dlq_query(imp_raw, clk_raw, dlq_path, f"{root}/{run}/chk/dlq", AVAILABLE_NOW).awaitTermination()
    spark.streams.removeListener(listener)
    return ReplayResult(tables, dlq_path, batches, log)


def replay_fire_log(spark: SparkSession, sf_dir: str, steps: int, settings: WindowSettings,
                    product_buckets: int | None = None, held_every: int | None = None) -> str:
    """The fire log of the same deliveries, as the table that its append stream wrote."""
    configure(spark)
    root = shared_dir(spark, "fire-log")
    staged = stage_steps(spark, sf_dir, f"{root}/staged", steps, product_buckets, held_every)
    folders = {s: ensure_dir(spark, f"{root}/in/{s}") for s in (IMPRESSION_SOURCE, CLICK_SOURCE)}
    log = in_state_tasks(fire_log_stream(*(stream_payload_files(spark, path, s) for s, path in folders.items()), settings))
    for i in range(steps + bool(held_every)):
        deliver(spark, staged, i, folders)
        writer = log.writeStream.format("parquet").outputMode("append").option("path", f"{root}/log").option("checkpointLocation", f"{root}/chk")
        with state_partitions(spark):
            q = writer.trigger(**AVAILABLE_NOW).start()
        q.awaitTermination()
    return f"{root}/log"


def replay_status(spark: SparkSession, sf_dir: str, steps: int) -> str:
    """The table of valid and invalid counts that a stream of the records wrote, delivered in
    slices of arrival time."""
    configure(spark)
    root = shared_dir(spark, "status")
    records = arrival_records(load_events(spark, sf_dir)).withColumn("ts_ms", F.unix_millis("arrived_at"))
    lo, width = step_width(records, steps)
    records.withColumn("step", F.expr(f"int((ts_ms - {lo}L) div {width}L)")).drop("ts_ms").write.partitionBy("step").parquet(f"{root}/staged")
    schema = "source string, value binary, arrived_at timestamp"
    stream = spark.readStream.schema(schema).parquet(ensure_dir(spark, f"{root}/in"))
    for i in range(steps):
        spark.read.schema(schema + ", step int").parquet(f"{root}/staged").filter(F.col("step") == i).drop("step").write.mode("append").parquet(f"{root}/in")
        start_status_query(status_stream(stream), f"{root}/counts", f"{root}/chk", AVAILABLE_NOW).awaitTermination()
    return f"{root}/counts"
