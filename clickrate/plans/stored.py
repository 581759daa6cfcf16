"""Queries over stored tables.

The CTR rows of all events, in 6 h windows over five products so that the
windows hold real counts, are written once per application and input as
``ctr_results_raw``; the minute parts and the latest rows are then derived
from that table, as are the distinct-product sketches; the latency states come from the records'
arrival times.  The queries read only these tables.
"""

from __future__ import annotations

from dataclasses import dataclass, replace

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from clickrate.functions.timekeys import month_key
from clickrate.operators import queries as Q
from clickrate.operators import rollups as R
from clickrate.operators.monitoring import activity_parts, latency_parts
from clickrate.operators.parse import parse_payloads
from clickrate.operators.window_agg import sink_projection
from clickrate.plans.batch import batch_ctr
from clickrate.session import shared_dir
from clickrate.sinks.tables import export, to_raw_rows, write_raw_table
from clickrate.sources.events_adapter import arrival_records, load_events
from clickrate.sources.result_table import newest_end_ms, read_raw_table

WINDOW_MS = 21_600_000
PRODUCT_BUCKETS = 5
PRODUCT = "product3"
DAY_S = 86_400


@dataclass(frozen=True)
class Store:
    raw: str
    minute: str
    latest: str
    latency: str
    activity: str
    newest: int  # the latest window_end, epoch ms


_STORES: dict[tuple[str, str], Store] = {}


def build_store(spark: SparkSession, sf: str) -> Store:
    """Write the tables under a new folder."""
    root = shared_dir(spark, "store")
    store = Store(f"{root}/ctr_results_raw", f"{root}/ctr_ml_view", f"{root}/ctr_latest_view", f"{root}/latency_view", f"{root}/activity_view", 0)
    write_raw_table(to_raw_rows(batch_ctr(spark, sf, f"{WINDOW_MS // 1000} seconds", PRODUCT_BUCKETS)), store.raw)
    rows = read_raw_table(spark, store.raw)
    (R.minute_parts(rows).withColumn("window_month", month_key(F.col("window_minute")))
     .write.partitionBy("window_month").parquet(store.minute))
    R.latest_per_product(rows, ("inserted_at",)).sortWithinPartitions("product_id").write.parquet(store.latest)
    arrived = parse_payloads(arrival_records(load_events(spark, sf))).filter("is_success")
    for parts, path in ((latency_parts(arrived, F.col("arrived_at"), F.col("event.timestamp")), store.latency), (activity_parts(rows), store.activity)):
        parts.withColumn("window_month", month_key(F.col("window_minute"))).write.partitionBy("window_month").parquet(path)
    return replace(store, newest=newest_end_ms(spark, store.raw) or 0)


def store(spark: SparkSession, sf: str) -> Store:
    """The application's tables for ``sf``, built at the first use."""
    key = (spark.sparkContext.applicationId, sf)
    if key not in _STORES:
        _STORES[key] = build_store(spark, sf)
    return _STORES[key]


def _ms(df: DataFrame) -> DataFrame:
    """Time columns as epoch ms, averages rounded to 9 digits."""
    return df.select(*[
        F.unix_millis(c).alias(c) if t == "timestamp" else F.round(c, 9).alias(c) if c == "avg_ctr" else F.col(c)
        for c, t in df.dtypes])


def _since(spark, sf, seconds: int) -> DataFrame:
    s = store(spark, sf)
    return read_raw_table(spark, s.raw, start_ms=s.newest - seconds * 1000)


def stored_count(spark, sf):
    return Q.row_count(read_raw_table(spark, store(spark, sf).raw))


def stored_last_day(spark, sf):
    """F6 with a day: the bound is a literal, so month folders are pruned."""
    return _ms(_since(spark, sf, DAY_S).drop("inserted_at", "window_month"))


def stored_avg_ctr_24h(spark, sf):
    return _ms(Q.average_ctr(_since(spark, sf, DAY_S)))


def stored_avg_ctr_24h_rollup(spark, sf):
    """A9 from the minute parts: sum of sums over sum of counts.  A part's minute is at or
    before the window ends in it, and these windows end on full minutes."""
    s = store(spark, sf)
    return _ms(Q.average_ctr_from_parts(spark.read.parquet(s.minute), s.newest - DAY_S * 1000))


def stored_minute_rollup(spark, sf):
    return _ms(R.finish_minute(spark.read.parquet(store(spark, sf).minute)))


def stored_minute_series(spark, sf):
    s = store(spark, sf)
    view = R.finish_minute(spark.read.parquet(s.minute))
    return _ms(Q.minute_series(view, minutes=DAY_S // 60, as_of=s.newest))


def stored_latest_top10(spark, sf):
    return _ms(Q.top_recent(spark.read.parquet(store(spark, sf).latest), 10))


def stored_latest_lookup(spark, sf):
    return _ms(Q.point_lookup(spark.read.parquet(store(spark, sf).latest), PRODUCT))


def stored_recent_top5(spark, sf):
    rows = read_raw_table(spark, store(spark, sf).raw)
    return _ms(Q.top_recent(rows, 5, ["product_id", "impressions", "clicks", "ctr", "window_end"]))


def stored_product_history(spark, sf):
    return _ms(Q.product_history(read_raw_table(spark, store(spark, sf).raw), PRODUCT))


def stored_sink_columns(spark, sf):
    """the six sink columns of every stored row, in insert order."""
    return _ms(sink_projection(read_raw_table(spark, store(spark, sf).raw)))


def stored_insert_times(spark, sf):
    """Stored rows by whether their insert time has whole milliseconds and lies after the
    table's first row was computed and before now."""
    at = F.unix_micros("inserted_at")
    now = F.unix_micros(F.current_timestamp())
    return read_raw_table(spark, store(spark, sf).raw).groupBy(
        (F.pmod(at, F.lit(1000)) == 0).alias("whole_ms"), ((at <= now) & (at > now - DAY_S * 1_000_000)).alias("recent")).agg(F.count(F.lit(1)).alias("n"))


def stored_order(spark, sf):
    """Q6: stored rows that stand behind a later (window_end, product_id) in their file; each file
    is one window partition, in the order of its rows."""
    rows = read_raw_table(spark, store(spark, sf).raw).select(F.col("_metadata.file_path").alias("file"), F.col("_metadata.row_index").alias("nr"), "window_end", "product_id")
    place = F.struct("window_end", "product_id")
    before = F.lag(place).over(W.partitionBy("file").orderBy("nr"))
    return rows.select((before > place).alias("late")).agg(F.count_if("late").alias("out_of_order"), F.count(F.lit(1)).alias("n"))


def stored_sample(spark, sf):
    """Q3: how many rows a sample of 100 has, and how many of them are rows of the table."""
    rows = read_raw_table(spark, store(spark, sf).raw).select("product_id", "window_end", "impressions", "clicks")
    taken = Q.sample(rows, 100)
    return taken.join(rows.distinct().withColumn("known", F.lit(True)), rows.columns, "left").agg(F.count(F.lit(1)).alias("n"), F.count("known").alias("known"))


def stored_export(spark, sf, fmt="csv"):
    """K7: the stored rows written as CSV with a header, and read back from it."""
    path = shared_dir(spark, f"export-{fmt}")
    rows = sink_projection(read_raw_table(spark, store(spark, sf).raw))
    export(_ms(rows), path, fmt)
    return spark.read.schema(_ms(rows).schema).option("header", True).format(fmt).load(path)


QUERIES = {f.__name__: f for f in (
    stored_count, stored_last_day, stored_avg_ctr_24h, stored_avg_ctr_24h_rollup, stored_minute_rollup,
    stored_minute_series, stored_latest_top10, stored_latest_lookup, stored_recent_top5, stored_product_history,
    stored_sink_columns, stored_insert_times, stored_order, stored_sample, stored_export)}
