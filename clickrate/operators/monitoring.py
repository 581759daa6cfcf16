"""What an operator of the CTR job watches, as aggregates over its own tables.

Counts and states are kept per minute and merge by addition or union, so any number of
batches, sources or workers can add to them and any period is answered by merging its minutes.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from clickrate.operators.series import MINUTE_MS, bucket_end, failing_runs, range_frames, sliding_sums, time_spine

HOUR_MS, DAY_MS = 60 * MINUTE_MS, 24 * 60 * MINUTE_MS
# Limits of the alert rules and how long they must hold.
ANOMALY_LIMIT, RECENT_MS, BASELINE_MS, BASELINE_OFFSET_MS = 0.5, HOUR_MS, DAY_MS, DAY_MS
RATE_WIDTH_MS = 5 * MINUTE_MS
LOW_RATE, LOW_HOLD_MS = 100.0, 15 * MINUTE_MS
INVALID_LIMIT, INVALID_HOLD_MS = 0.1, 10 * MINUTE_MS


# -- V8: CTR anomaly ---------------------------------------------------------------------------

def _judged(averages: DataFrame) -> DataFrame:
    """Adds the relative change and whether it is above the limit.  Without rows in either period both
    are unknown: null, not anomalous.  Against a baseline of zero (windows without clicks, or
    without impressions) no ratio exists: null, and anomalous if there are clicks now."""
    recent, baseline = F.col("recent_ctr"), F.col("baseline_ctr")
    change = F.when(baseline > 0, (recent - baseline) / baseline)
    anomalous = F.coalesce(F.when(baseline > 0, change > ANOMALY_LIMIT).when(baseline == 0, recent > 0), F.lit(False))
    return averages.select("*", change.alias("change"), anomalous.alias("anomalous"))


def ctr_anomaly(rows: DataFrame, as_of_ms: int) -> DataFrame:
    """product_id, recent_ctr, baseline_ctr, change, anomalous at one point in time: the average
    CTR of windows that ended in (as_of - 1 h, as_of] against those in (as_of - 48 h, as_of - 24 h].

    One scan and one aggregate of both ranges; rows in neither are filtered before it."""
    end = F.unix_millis("window_end")
    recent = (end > as_of_ms - RECENT_MS) & (end <= as_of_ms)
    newest = as_of_ms - BASELINE_OFFSET_MS
    baseline = (end > newest - BASELINE_MS) & (end <= newest)
    averages = (rows.filter(recent | baseline).groupBy("product_id")
                .agg(F.avg(F.when(recent, F.col("ctr"))).alias("recent_ctr"), F.avg(F.when(baseline, F.col("ctr"))).alias("baseline_ctr")))
    return _judged(averages)


def ctr_anomaly_series(parts: DataFrame) -> DataFrame:
    """The same at every minute in which a product has results, from the minute parts (A5): two
    RANGE frames over (product, time).  product_id, point, recent_ctr, baseline_ctr, change, anomalous."""
    rows = parts.select("product_id", F.unix_millis("window_minute").alias("point"), "ctr_sum", "ctr_n")
    offset = BASELINE_OFFSET_MS
    framed = range_frames(rows, "product_id", "point", {"recent": (-RECENT_MS, 0, ("ctr_sum", "ctr_n")),
                                                        "baseline": (-offset - BASELINE_MS, -offset, ("ctr_sum", "ctr_n"))})
    averages = framed.select("product_id", "point", (F.col("recent_ctr_sum") / F.col("recent_ctr_n")).alias("recent_ctr"),
                             (F.col("baseline_ctr_sum") / F.col("baseline_ctr_n")).alias("baseline_ctr"))
    return _judged(averages)


# -- V9, V10: rates -----------------------------------------------------------------------------

def status_counts(parsed: DataFrame, time: Column, keys: Sequence[str] = ("source",), step_ms: int = MINUTE_MS) -> DataFrame:
    """keys, point, valid, invalid: records of every bucket of ``time``, by parse result."""
    return (parsed.groupBy(*keys, bucket_end(F.unix_millis(time), step_ms).alias("point"))
            .agg(F.count_if("is_success").alias("valid"), F.count_if(~F.col("is_success")).alias("invalid")))


def invalid_rate(counts: DataFrame, keys: Sequence[str] = ("source",), width_ms: int = RATE_WIDTH_MS) -> DataFrame:
    """V9: keys, point, valid, invalid, invalid_rate, failing over sliding windows.  Windows
    without records have no rate and no row."""
    sums = sliding_sums(counts, ("valid", "invalid"), width_ms, keys=keys)
    rate = F.col("invalid") / (F.col("valid") + F.col("invalid"))
    return sums.select("*", rate.alias("invalid_rate"), (rate > INVALID_LIMIT).alias("failing"))


def invalid_rate_alerts(counts: DataFrame, keys: Sequence[str] = ("source",)) -> DataFrame:
    """V9: runs of failing points that were held for ten minutes."""
    return failing_runs(invalid_rate(counts, keys), F.col("failing"), INVALID_HOLD_MS, keys=keys)


def event_rate(spark: SparkSession, counts: DataFrame, first_ms: int, last_ms: int, min_rate: float = LOW_RATE,
               width_ms: int = RATE_WIDTH_MS) -> DataFrame:
    """Point, events, rate (a second), low for every minute of the period, counted or not,
    whose window lies in it.  The spine is generated and takes the sliding counts by a left join,
    so windows in which nothing at all arrived are there, with 0."""
    whole = counts.groupBy("point").agg(F.sum("valid").alias("events"))
    spine = time_spine(spark, first_ms + width_ms, last_ms)
    joined = spine.join(sliding_sums(whole, ("events",), width_ms), "point", "left")
    events = F.coalesce("events", F.lit(0))
    rate = events / F.lit(width_ms / 1000.0)
    return joined.select("point", events.alias("events"), rate.alias("rate"), (rate < min_rate).alias("low"))


def event_rate_alerts(rates: DataFrame) -> DataFrame:
    """Runs of low points that were held for fifteen minutes."""
    return failing_runs(rates, F.col("low"), LOW_HOLD_MS)


# -- V12: latency percentiles ---------------------------------------------------------------------

PRECISION_BITS = 7  # values of one bucket differ by less than 1 part in 2^7
PERCENTILES = (0.5, 0.95, 0.99)


def latency_bucket(ms: Column) -> Column:
    """Number of the bucket of a latency: its own value below 2^8, else 2^7 buckets for every
    doubling.  Whole-number arithmetic, so every engine agrees on it.  Negative latencies count as 0."""
    ms = F.greatest(ms, F.lit(0).cast("long"))
    shift = F.greatest(F.length(F.bin(ms)) - (PRECISION_BITS + 1), F.lit(0))
    return (shift.cast("long") * (1 << PRECISION_BITS) + F.call_function("shiftright", ms, shift.cast("int"))).cast("long")


def bucket_latency(bucket: Column) -> Column:
    """The smallest latency of a bucket."""
    wide = 1 << PRECISION_BITS
    shift = F.greatest(F.floor(bucket / wide) - 1, F.lit(0)).cast("int")
    return F.call_function("shiftleft", bucket - shift.cast("long") * wide, shift)


def latency_parts(records: DataFrame, arrived: Column, event_ms: Column) -> DataFrame:
    """Mergeable quantile state: window_minute, bucket, n.  Merging is addition, so any split of
    the records gives the same state, and a period's percentiles come from the sum of its minutes."""
    arrived_ms = F.unix_millis(arrived)
    return (records.groupBy(F.timestamp_millis(arrived_ms - F.pmod(arrived_ms, F.lit(MINUTE_MS))).alias("window_minute"),
                            latency_bucket(arrived_ms - event_ms).alias("bucket"))
            .agg(F.count(F.lit(1)).alias("n")))


def merge_latency(parts: DataFrame) -> DataFrame:
    return parts.groupBy("window_minute", "bucket").agg(F.sum("n").cast("long").alias("n"))


def latency_percentiles(parts: DataFrame, period: Column, name: str = "period", percentiles: Sequence[float] = PERCENTILES) -> DataFrame:
    """Nearest-rank percentiles of each period (a truncation of ``window_minute``): the smallest
    latency of the bucket that holds the value of rank ceil(q * n).  The rank is exact; the value
    is at most 1/128 of it below the true one.  A period has one row a bucket, so what is sorted
    does not grow with the records."""
    merged = parts.groupBy(period.alias(name), "bucket").agg(F.sum("n").alias("n"))
    order = W.partitionBy(name).orderBy("bucket")
    upto = merged.withColumn("upto", F.sum("n").over(order.rowsBetween(W.unboundedPreceding, W.currentRow)))
    total = upto.withColumn("total", F.sum("n").over(W.partitionBy(name)))
    found = [F.min(F.when(F.col("upto") >= F.ceil(F.col("total") * F.lit(q)), bucket_latency(F.col("bucket")))).alias(f"p{round(q * 100)}") for q in percentiles]
    return total.groupBy(name).agg(F.max("total").cast("long").alias("n"), *found)


# -- V12: active products, CTR distribution --------------------------------------------------------

LOG_K = 12  # relative standard error 1.6 %; exact up to some hundred products


def activity_parts(rows: DataFrame) -> DataFrame:
    """Mergeable distinct-count state of each minute of window_end: window_minute, products.
    Merging is a union of sketches, so windows that are emitted again change nothing."""
    return rows.groupBy(F.date_trunc("minute", "window_end").alias("window_minute")).agg(F.hll_sketch_agg("product_id", F.lit(LOG_K)).alias("products"))


def merge_activity(parts: DataFrame, keys: Sequence[str] = ("window_minute",)) -> DataFrame:
    return parts.groupBy(*keys).agg(F.hll_union_agg("products").alias("products"))


def active_products(parts: DataFrame, period: Column, name: str = "period") -> DataFrame:
    """Products with results in each period (a truncation of ``window_minute``)."""
    merged = parts.groupBy(period.alias(name)).agg(F.hll_union_agg("products").alias("products"))
    return merged.select(name, F.hll_sketch_estimate("products").alias("active_products"))


def ctr_distribution(rows: DataFrame, period: Column, name: str = "period", steps: int = 20) -> DataFrame:
    """Windows of each period by CTR: bucket b holds [b / steps, (b + 1) / steps), the last one all
    ratios of 1 and more.  Counts, so buckets of any periods add up."""
    bucket = F.least(F.floor(F.col("ctr") * steps), F.lit(steps)).cast("int")
    return rows.groupBy(period.alias(name), bucket.alias("bucket")).agg(F.count(F.lit(1)).alias("windows"))
