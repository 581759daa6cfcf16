"""Minute rollup, mergeable states, latest row per product.

All of them are plain aggregates with map-side partial aggregation; none
collects a group's rows (``max_by`` keeps one candidate per partial buffer).
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from clickrate.functions.timekeys import minute_bucket


def as_timestamps(results: DataFrame) -> DataFrame:
    """CTR rows with ms bounds → rows with timestamp bounds."""
    return (results
            .withColumn("window_start", F.timestamp_millis("window_start"))
            .withColumn("window_end", F.timestamp_millis("window_end")))


def minute_parts(rows: DataFrame, extra_keys: tuple[str, ...] = ()) -> DataFrame:
    """A5 states per (product_id, window_minute): ctr sum and count (the avg
    state), impression / click sums, max window_end.  ``rows`` has
    timestamp bounds.  Parts from any split of the rows merge to the same
    result (``merge_minute_parts``)."""
    return (rows
            .groupBy(*extra_keys, "product_id", minute_bucket(F.col("window_end")).alias("window_minute"))
            .agg(F.sum("ctr").alias("ctr_sum"),
                 F.count("ctr").alias("ctr_n"),
                 F.sum("impressions").cast("long").alias("impressions"),
                 F.sum("clicks").cast("long").alias("clicks"),
                 F.max("window_end").alias("latest_window")))


def merge_minute_parts(parts: DataFrame) -> DataFrame:
    """Merge states → the same columns as ``minute_parts`` (still mergeable)."""
    return (parts.groupBy("product_id", "window_minute")
            .agg(F.sum("ctr_sum").alias("ctr_sum"),
                 F.sum("ctr_n").cast("long").alias("ctr_n"),
                 F.sum("impressions").cast("long").alias("impressions"),
                 F.sum("clicks").cast("long").alias("clicks"),
                 F.max("latest_window").alias("latest_window")))


def finish_minute(parts: DataFrame) -> DataFrame:
    """avg/sum/sum/max merge → the view's columns (unweighted average)."""
    merged = merge_minute_parts(parts)
    return merged.select(
        "product_id", "window_minute",
        (F.col("ctr_sum") / F.col("ctr_n")).alias("avg_ctr"),
        F.col("impressions").alias("total_impressions"),
        F.col("clicks").alias("total_clicks"),
        "latest_window")


def minute_rollup(rows: DataFrame) -> DataFrame:
    """A4 in one step: avg(ctr), sum, sum, max(window_end) per minute."""
    return (rows
            .groupBy("product_id", minute_bucket(F.col("window_end")).alias("window_minute"))
            .agg(F.avg("ctr").alias("avg_ctr"),
                 F.sum("impressions").cast("long").alias("total_impressions"),
                 F.sum("clicks").cast("long").alias("total_clicks"),
                 F.max("window_end").alias("latest_window")))


def latest_per_product(rows: DataFrame, version_cols: tuple[str, ...] = ()) -> DataFrame:
    """A6 + F4: the row with the highest window_end per product.  Ties go to
    the later version (``inserted_at`` / batch id, when given), then to the
    larger count total (counts only grow across re-fires)."""
    order = F.struct(F.col("window_end"), *[F.col(c) for c in version_cols],
                     (F.col("impressions") + F.col("clicks")).alias("_total"))
    best = F.max_by(F.struct("ctr", "impressions", "clicks", "window_end"), order)
    return (rows.groupBy("product_id").agg(best.alias("_b"))
            .select("product_id",
                    F.col("_b.ctr").alias("latest_ctr"),
                    F.col("_b.impressions").alias("latest_impressions"),
                    F.col("_b.clicks").alias("latest_clicks"),
                    F.col("_b.window_end").alias("window_end")))


def latest_per_product_argmax(rows: DataFrame) -> DataFrame:
    """argMax of each column by window_end, and max(window_end)."""
    return rows.groupBy("product_id").agg(
        F.max_by("ctr", "window_end").alias("latest_ctr"),
        F.max_by("impressions", "window_end").alias("latest_impressions"),
        F.max_by("clicks", "window_end").alias("latest_clicks"),
        F.max("window_end").alias("window_end"))


def latest_merge(latest_parts: DataFrame, version_col: str | None = None) -> DataFrame:
    """Merge several ``latest_per_product`` outputs (e.g. one per batch) →
    one row per product.  Same ordering rule as A6."""
    renamed = latest_parts.select(
        "product_id", F.col("latest_ctr").alias("ctr"),
        F.col("latest_impressions").alias("impressions"),
        F.col("latest_clicks").alias("clicks"), "window_end",
        *([version_col] if version_col else []))
    return latest_per_product(renamed, (version_col,) if version_col else ())
