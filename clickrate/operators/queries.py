"""Read-side queries over CTR rows.

Time filters take an ``as_of`` point.  ``None`` means "latest window_end in
the data", evaluated as a scalar subquery inside the same plan (no driver
round trip); a number is epoch ms and becomes a literal, which the scan
can use for pruning.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from clickrate.functions.timekeys import month_keys_between


def as_of_point(rows: DataFrame, as_of: int | None = None, col: str = "window_end") -> Column:
    if as_of is not None:
        return F.timestamp_millis(F.lit(as_of)) if dict(rows.dtypes)[col] == "timestamp" else F.lit(as_of)
    return rows.select(F.max(col)).scalar()


def _minus(point: Column, rows: DataFrame, col: str, seconds: int) -> Column:
    if dict(rows.dtypes)[col] == "timestamp":
        return point - F.make_interval(secs=F.lit(seconds))
    return point - F.lit(seconds * 1000)


def point_lookup(rows: DataFrame, product_id: str) -> DataFrame:
    """F5."""
    return rows.filter(F.col("product_id") == F.lit(product_id))


def since(rows: DataFrame, seconds: int, as_of: int | None = None, col: str = "window_end") -> DataFrame:
    """rows with ``col >= as_of − seconds``."""
    point = as_of_point(rows, as_of, col)
    return rows.filter(F.col(col) >= _minus(point, rows, col, seconds))


def last_hour(rows: DataFrame, as_of: int | None = None) -> DataFrame:
    return since(rows, 3600, as_of)


def avg_ctr_since(rows: DataFrame, seconds: int = 86_400, as_of: int | None = None) -> DataFrame:
    """Average CTR per product over the trailing period."""
    return average_ctr(since(rows, seconds, as_of))


def average_ctr(rows: DataFrame) -> DataFrame:
    """Unweighted average CTR per product."""
    return rows.groupBy("product_id").agg(F.avg("ctr").alias("avg_ctr"))


def average_ctr_from_parts(parts: DataFrame, start_ms: int) -> DataFrame:
    """The same from minute parts (partitioned by ``window_month``) since ``start_ms``: one
    aggregate over the stored sums and counts."""
    month = month_keys_between(start_ms, start_ms)[0]
    recent = parts.filter((F.col("window_month") >= month)
                          & (F.col("window_minute") >= F.timestamp_millis(F.lit(start_ms))))
    return recent.groupBy("product_id").agg((F.sum("ctr_sum") / F.sum("ctr_n")).alias("avg_ctr"))


def row_count(rows: DataFrame) -> DataFrame:
    """A8."""
    return rows.agg(F.count(F.lit(1)).alias("n"))


def top_recent(rows: DataFrame, n: int, columns: list[str] | None = None,
               order_col: str = "window_end") -> DataFrame:
    """Q1 / Q2: most recent ``n`` rows by window_end (ties → product_id).
    Planned as TakeOrderedAndProject: a per-partition top-n, then one merge
    of n rows per partition."""
    ordered = rows.orderBy(F.col(order_col).desc(), F.col("product_id").asc())
    if columns:
        ordered = ordered.select(*columns)
    return ordered.limit(n)


def sample(rows: DataFrame, n: int = 100) -> DataFrame:
    """Q3: any ``n`` rows."""
    return rows.limit(n)


def minute_series(minute_view: DataFrame, minutes: int = 10, as_of: int | None = None,
                  limit: int = 20, as_of_rows: DataFrame | None = None) -> DataFrame:
    """Q4: finished minute rollup of the trailing ``minutes``, ordered by
    (product_id, window_minute), first ``limit`` rows.  ``as_of`` defaults
    to the latest window_end of ``as_of_rows`` (the raw rows)."""
    ref = as_of_rows if as_of_rows is not None else minute_view.withColumnRenamed("latest_window", "window_end")
    point = as_of_point(ref, as_of, "window_end")
    lo = _minus(point, ref, "window_end", minutes * 60)
    return (minute_view.filter(F.col("window_minute") >= lo)
            .select("product_id", "window_minute", "avg_ctr")
            .orderBy("product_id", "window_minute").limit(limit))


def product_history(rows: DataFrame, product_id: str) -> DataFrame:
    """Q5: one product's rows, newest first."""
    return (point_lookup(rows, product_id)
            .select("product_id", "impressions", "clicks", "ctr", "window_start", "window_end")
            .orderBy(F.col("window_end").desc()))
