"""K1, K3, K7: stored result table writes and exports.

``ctr_results_raw`` is Parquet partitioned by ``window_month`` (yyyyMM of
window_end) and sorted by (window_end, product_id) inside each file, so
time-range reads prune month folders and skip row groups by min/max.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from clickrate.functions.timekeys import insert_time, month_key


def to_raw_rows(results: DataFrame, inserted_at=None) -> DataFrame:
    """CTR rows (ms bounds) → ``ctr_results_raw`` rows."""
    ws = F.timestamp_millis(F.col("window_start"))
    we = F.timestamp_millis(F.col("window_end"))
    return results.select(
        "product_id", "ctr", "impressions", "clicks",
        ws.alias("window_start"), we.alias("window_end"),
        (inserted_at if inserted_at is not None else insert_time()).alias("inserted_at"),
        month_key(we).alias("window_month"),
    )


def write_raw_table(rows: DataFrame, path: str, mode: str = "append") -> None:
    """K3: month folders, each task's rows sorted by (window_end, product_id).
    No exchange is added: a range repartition here would sample, and so
    recompute, the whole upstream aggregation.  ``compact_months`` gives
    stored months tight, non-overlapping time ranges per file later."""
    (rows.sortWithinPartitions("window_month", "window_end", "product_id")
         .write.mode(mode).partitionBy("window_month").parquet(path))


def compact_months(spark, path: str, dest: str, months: list[int], files_per_month: int = 8) -> None:
    """Write the given months of the table at ``path`` to the table at ``dest``, in at most
    ``files_per_month`` files a month that each cover one contiguous time slice (row-group and
    file min/max pruning for time-range reads).  The source is left as it is, so rows appended
    to it meanwhile are not lost; readers move to ``dest`` once appends have moved."""
    from clickrate.schema import RAW_TABLE_SCHEMA

    src = spark.read.schema(RAW_TABLE_SCHEMA).parquet(path)
    for month in months:
        (src.filter(F.col("window_month") == month).repartitionByRange(files_per_month, "window_end", "product_id")
            .sortWithinPartitions("window_end", "product_id")
            .write.mode("append").partitionBy("window_month").parquet(dest))


def export(rows: DataFrame, path: str, fmt: str = "csv") -> None:
    """K7: CSV with a header row, or Parquet."""
    writer = rows.write.mode("overwrite")
    if fmt == "csv":
        writer.option("header", True).csv(path)
    elif fmt == "parquet":
        writer.parquet(path)
    else:
        raise ValueError(f"unsupported export format {fmt!r}")
