"""Scans of the stored tables, with month-partition pruning."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from clickrate.functions.timekeys import month_keys_between
from clickrate.schema import RAW_TABLE_SCHEMA


def read_raw_table(spark: SparkSession, path: str, start_ms: int | None = None,
                   end_ms: int | None = None) -> DataFrame:
    """Rows of ``ctr_results_raw``.  A time range on ``window_end`` also
    becomes a filter on ``window_month`` (a list for a closed range, a bound
    for one side) so only those month folders are read; the ``window_end``
    bounds reach the Parquet reader as pushed filters (row groups are skipped
    by their min/max)."""
    df = spark.read.schema(RAW_TABLE_SCHEMA).parquet(path)
    if start_ms is not None or end_ms is not None:
        lo = start_ms if start_ms is not None else 0
        hi = end_ms if end_ms is not None else 253402300799000  # 9999-12-31
        if start_ms is not None and end_ms is not None:
            df = df.filter(F.col("window_month").isin(month_keys_between(lo, hi)))
        elif start_ms is not None:
            df = df.filter(F.col("window_month") >= month_keys_between(lo, lo)[0])
        else:
            df = df.filter(F.col("window_month") <= month_keys_between(hi, hi)[0])
        if start_ms is not None:
            df = df.filter(F.col("window_end") >= F.timestamp_millis(F.lit(lo)))
        if end_ms is not None:
            df = df.filter(F.col("window_end") <= F.timestamp_millis(F.lit(hi)))
    return df


def newest_end_ms(spark: SparkSession, path: str) -> int | None:
    """The latest window_end as epoch ms (null for an empty table): the newest month is found
    from the folder keys, then only that month is read."""
    df = spark.read.schema(RAW_TABLE_SCHEMA).parquet(path)
    month = df.agg(F.max("window_month")).first()[0]
    if month is None:
        return None
    return df.filter(F.col("window_month") == month).agg(F.max(F.unix_millis("window_end"))).first()[0]
