"""Replay-safe incremental tables fed from ``foreachBatch``.

``foreachBatch`` is at-least-once: after a failure the same batch id is run
again with the same rows.  Every table is therefore *versioned by batch
id*: a batch writes only its own partitions (window_month, window_day, batch_id)
with dynamic partition overwrite, so a replay replaces exactly what the first
attempt wrote, and readers take the newest version of each key.

A query with a fresh checkpoint counts its batches from 0 again.  Its run (the
streaming query's id, which lives in the checkpoint) therefore gets a base
above every version written before, kept in ``_runs``; ``batch_id`` in the
tables is base + batch, so later runs rank above earlier ones and never
overwrite them, while a restart from the same checkpoint keeps its base.

* ``final``: every emitted CTR row in the columns of ``ctr_results_raw``; ``read_raw_table``
  reads it as the log of all emitted rows, ``final_rows`` keeps the newest per window.
* ``minute_parts``: the whole state (A5) of every minute a batch touched, computed anew from
  the newest rows of its windows, so a window that is emitted again is not counted twice.
* ``latest``: per batch, the latest row per product; ``latest_view`` merges
  them with the same ordering (window_end, batch).
* ``activity``: per batch and minute, the sketch of its products; merging is a union.

A batch's rows are stored first, under ``_incoming`` in place of the batch before, and all tables
are written from there: the window state is computed once, and only that one stage's tasks send
the state store's counters to the driver.  Every task of a plan over the state sends a counter for
each of its partitions, so each further stage would send as many as the partitions squared.

A batch reads only the days its windows lie in, however old the job is.  ``archive(days)`` is a
plain job for days that are over: it writes their rows to the same tables under ``archive``, in
one partition a day, sorted, and leaves the live rows alone.  Views read both and take the newest
version of each key, so rows that are in both count once; live folders of archived days may be
removed when no run can go back to them.  One query at a time may write a set of tables.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from clickrate.functions.timekeys import minute_bucket, month_key
from clickrate.operators import rollups as R
from clickrate.operators.monitoring import activity_parts, merge_activity
from clickrate.schema import LATEST_SCHEMA, MINUTE_PARTS_SCHEMA, RAW_TABLE_SCHEMA
from clickrate.sinks.tables import to_raw_rows

FINAL, MINUTE_PARTS, LATEST, ACTIVITY = "final", "minute_parts", "latest", "activity"
RUNS, ARCHIVE, INCOMING = "_runs", "archive", "_incoming"
DAY = ["window_month", "window_day"]
_VERSION = [T.StructField("window_month", T.IntegerType()), T.StructField("window_day", T.DateType()), T.StructField("batch_id", T.LongType())]
_SCHEMAS = {name: T.StructType([*[f for f in fields if f.name != "window_month"], *_VERSION]) for name, fields in (
    (FINAL, RAW_TABLE_SCHEMA.fields), (MINUTE_PARTS, MINUTE_PARTS_SCHEMA.fields), (LATEST, LATEST_SCHEMA.fields),
    (ACTIVITY, [T.StructField("window_minute", T.TimestampType()), T.StructField("products", T.BinaryType())]))}
# The time that places a row in its day, and what its versions are versions of.
_TIME = {FINAL: "window_end", MINUTE_PARTS: "window_minute", LATEST: "window_end", ACTIVITY: "window_minute"}
_KEYS = {FINAL: ["product_id", "window_start", "batch_id"], MINUTE_PARTS: ["product_id", "window_minute"], LATEST: ["product_id"]}


def _exists(spark: SparkSession, path: str) -> bool:
    hpath = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return hpath.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(hpath)


def _placed(name: str, rows: DataFrame, version) -> DataFrame:
    """Rows with their day and version, in the table's columns."""
    at = F.col(_TIME[name])
    return rows.withColumns({"window_month": month_key(at), "window_day": F.to_date(at), "batch_id": version}).select(_SCHEMAS[name].names)


def newest(name: str, rows: DataFrame) -> DataFrame:
    """The rows of one table with what later versions replace left out; of ``final`` every
    emission stays, once."""
    if name == ACTIVITY:
        merged = rows.groupBy("window_minute", *DAY).agg(F.hll_union_agg("products").alias("products"), F.max("batch_id").alias("batch_id"))
        return merged.select(_SCHEMAS[name].names)
    keys = _KEYS[name]
    order = [F.col("window_end")] if name == LATEST else []
    total = [(F.col("latest_impressions") + F.col("latest_clicks"))] if name == LATEST else []
    rest = [c for c in _SCHEMAS[name].names if c not in keys]
    best = F.max_by(F.struct(*rest), F.struct(*order, F.col("batch_id"), *total)).alias("_b")
    return rows.groupBy(*keys).agg(best).select(*keys, "_b.*").select(_SCHEMAS[name].names)


def _ms_bounds(rows: DataFrame) -> DataFrame:
    return rows.withColumns({c: F.unix_millis(c) for c in ("window_start", "window_end")})


def final_rows_from(versions: DataFrame) -> DataFrame:
    """Last version of each (product_id, window) → CTR rows."""
    best = F.max_by(F.struct("impressions", "clicks", "ctr", "window_end"), F.col("batch_id"))
    return (versions.groupBy("product_id", "window_start").agg(best.alias("_b"))
            .select("product_id", F.col("_b.impressions").alias("impressions"),
                    F.col("_b.clicks").alias("clicks"), F.col("_b.ctr").alias("ctr"),
                    "window_start", F.col("_b.window_end").alias("window_end")))


class IncrementalTables:
    """The tables under one root folder."""

    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.root = spark, root.rstrip("/")
        self._bases: dict[str, int] = {}

    def path(self, name: str, archived: bool = False) -> str:
        return f"{self.root}/{ARCHIVE}/{name}" if archived else f"{self.root}/{name}"

    # -- read side ------------------------------------------------------------
    def _files(self, name: str, root: str, folders: list[str]) -> DataFrame:
        return self.spark.read.schema(_SCHEMAS[name]).option("basePath", root).parquet(*folders).select(_SCHEMAS[name].names)

    def _read(self, name: str, days: list | None = None, live_only: bool = False) -> DataFrame:
        """Every stored version of one table: all of it, or those of some (month, day)s, in which
        case only the folders of these days are listed."""
        out = self.spark.createDataFrame([], _SCHEMAS[name])
        for archived in (False,) if live_only else (False, True):
            root = self.path(name, archived)
            folders = [root] if days is None else [f"{root}/window_month={m}/window_day={d}" for m, d in days]
            folders = [f for f in folders if _exists(self.spark, f)]
            if folders:
                out = out.unionByName(self._files(name, root, folders))
        return out

    def emission_log(self) -> DataFrame:
        """Every emitted row, with ms bounds."""
        return _ms_bounds(newest(FINAL, self._read(FINAL)))

    def final_rows(self) -> DataFrame:
        return final_rows_from(_ms_bounds(self._read(FINAL)))

    def minute_view(self) -> DataFrame:
        return R.finish_minute(newest(MINUTE_PARTS, self._read(MINUTE_PARTS)).drop(*DAY, "batch_id"))

    def latest_view(self) -> DataFrame:
        return R.latest_merge(self._read(LATEST), "batch_id")

    def activity(self) -> DataFrame:
        """window_minute and the sketch of the products with results in it."""
        return merge_activity(self._read(ACTIVITY))

    # -- write side (called once per micro-batch) --------------------------
    def _base(self, run: str) -> int:
        """The version of the run's batch 0; looked up or set once per run."""
        if run not in self._bases:
            path = self.path(RUNS)
            known = ({r["run"]: r["base"] for r in self.spark.read.schema("run string, base long").json(path).collect()}
                     if _exists(self.spark, path) else {})
            if run not in known:
                top = [self._read(n).agg(F.max("batch_id")).first()[0] for n in _SCHEMAS] if known else []
                known[run] = max([-1, *(int(x) for x in top if x is not None)]) + 1
                (self.spark.createDataFrame([(run, known[run])], "run string, base long")
                 .coalesce(1).write.mode("append").json(path))
            self._bases[run] = known[run]
        return self._bases[run]

    def _write(self, name: str, rows: DataFrame, archived: bool = False) -> None:
        (rows.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
         .partitionBy(*DAY, *([] if archived else ["batch_id"])).parquet(self.path(name, archived)))

    def apply_batch(self, batch: DataFrame, batch_id: int, run: str | None = None) -> None:
        """``batch``: CTR rows (ms bounds) emitted by the stream in this batch.  ``run``
        names the checkpoint it belongs to (default: the id of the running query)."""
        run = run or self.spark.sparkContext.getLocalProperty("sql.streaming.queryId") or "none"
        batch_id = self._base(run) + batch_id
        version = F.lit(batch_id).cast("long")
        rows = _placed(FINAL, self._stored(to_raw_rows(batch)), version)
        # A few dates and two times reach the driver: they name the folders to read and bound the scan.
        b = rows.agg(F.collect_set(F.struct("window_month", "window_day")).alias("days"),
                     F.unix_millis(F.min(minute_bucket(F.col("window_end")))).alias("lo"), F.unix_millis(F.max(minute_bucket(F.col("window_end")))).alias("hi")).first()
        if b["days"]:
            self._write(MINUTE_PARTS, _placed(MINUTE_PARTS, self._touched_minutes(rows, batch_id, b), version))
            self._write(LATEST, _placed(LATEST, R.latest_per_product(rows, ("batch_id",)), version))
            self._write(ACTIVITY, _placed(ACTIVITY, activity_parts(rows), version))
        self._write(FINAL, rows.sortWithinPartitions(*DAY, "window_end", "product_id"))

    def _stored(self, rows: DataFrame) -> DataFrame:
        """The batch's rows, written once and read back, so that what follows does not carry the stream's plan."""
        path = self.path(INCOMING)
        rows.write.mode("overwrite").parquet(path)
        return self.spark.read.schema(RAW_TABLE_SCHEMA).parquet(path)

    def _touched_minutes(self, rows: DataFrame, batch_id: int, b) -> DataFrame:
        """The state of each (product, minute) of the batch, from its windows' newest rows."""
        columns = ["product_id", "window_start", "window_end", "impressions", "clicks", "ctr", "batch_id"]
        end = F.col("window_end")
        before = (self._read(FINAL, [(d["window_month"], d["window_day"]) for d in b["days"]])
                  .filter((F.col("batch_id") < batch_id) & (end >= F.timestamp_millis(F.lit(b["lo"]))) & (end < F.timestamp_millis(F.lit(b["hi"] + 60_000)))))
        minute = minute_bucket(end).alias("window_minute")
        touched = rows.select("product_id", minute).distinct()
        known = before.select(*columns, minute).join(touched, ["product_id", "window_minute"], "left_semi").select(columns)
        return R.minute_parts(final_rows_from(known.unionByName(rows.select(columns))))

    # -- maintenance -----------------------------------------------------------
    def archive(self, days: list) -> None:
        """Write the live rows of the given days (dates) to the archive, one partition a day.
        Running it again writes the same, from the live rows and what was archived before."""
        named = [(d.year * 100 + d.month, d) for d in days]
        for name in _SCHEMAS:
            # Stored first: what is written must not depend on the partitions that it replaces.
            scratch = f"{self.path(name, archived=True)}-next"
            newest(name, self._read(name, named)).write.mode("overwrite").parquet(scratch)
            rows = self.spark.read.schema(_SCHEMAS[name]).parquet(scratch)
            order = [*DAY, *(c for c in (_TIME[name], "product_id") if c in _SCHEMAS[name].names)]
            self._write(name, rows.repartitionByRange(*order).sortWithinPartitions(*order), archived=True)
