"""Event-time windows → counts → CTR rows.

The same functions serve batch and streaming.  ``window_counts`` is one hash
aggregate keyed by (product_id, window): Spark runs it as partial aggregate
→ exchange → final aggregate, so a hot product is pre-counted inside every
map task and only one row per (task, product, window) crosses the shuffle.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from clickrate.functions.ratio import ctr
from clickrate.functions.timestamps import event_time
from clickrate.functions.validity import is_click, is_impression
from clickrate.schema import SINK_COLUMNS

DEFAULT_WINDOW = "10 seconds"


def with_event_time(events: DataFrame, ms_col: str = "timestamp") -> DataFrame:
    """``event_time`` timestamp from the epoch-ms column."""
    return events.withColumn("event_time", event_time(F.col(ms_col)))


def count_exprs() -> list[Column]:
    """A1: the dual count.  Other event types add nothing."""
    return [
        F.count_if(is_impression(F.col("event_type"))).alias("impressions"),
        F.count_if(is_click(F.col("event_type"))).alias("clicks"),
    ]


def window_counts(events: DataFrame, window: str = DEFAULT_WINDOW,
                  agg_exprs: Sequence[Column] | None = None) -> DataFrame:
    """A1 + W3: per (product_id, tumbling window) counts.  Windows are epoch
    aligned and half open [start, end)."""
    return (events
            .groupBy("product_id", F.window("event_time", window).alias("window"))
            .agg(*(agg_exprs or count_exprs())))


def merge_counts(parts: DataFrame, keys: Sequence[str] = ("product_id", "window_start", "window_end")) -> DataFrame:
    """A2: merge partial count pairs by field-wise addition."""
    return parts.groupBy(*keys).agg(
        F.sum("impressions").cast("long").alias("impressions"),
        F.sum("clicks").cast("long").alias("clicks"))


def with_ratio(counts: DataFrame) -> DataFrame:
    """P11 on a frame with impressions / clicks."""
    return counts.withColumn("ctr", ctr(F.col("impressions"), F.col("clicks")))


def ctr_results(counts: DataFrame) -> DataFrame:
    """A3: key + window bounds (epoch ms) + ratio, CTRResult column order."""
    return counts.select(
        "product_id",
        "impressions",
        "clicks",
        ctr(F.col("impressions"), F.col("clicks")).alias("ctr"),
        F.unix_millis(F.col("window.start")).alias("window_start"),
        F.unix_millis(F.col("window.end")).alias("window_end"),
    )


def compute_ctr(events: DataFrame, window: str = DEFAULT_WINDOW,
                agg_exprs: Sequence[Column] | None = None,
                result_fn: Callable[[DataFrame], DataFrame] | None = None) -> DataFrame:
    """Valid events (with ``timestamp`` ms) → CTR rows.  ``agg_exprs`` and
    ``result_fn`` are the two extension points (aggregate, window function)."""
    counts = window_counts(with_event_time(events), window, agg_exprs)
    return (result_fn or ctr_results)(counts)


def sink_projection(results: DataFrame) -> DataFrame:
    """the six sink columns in insert order."""
    return results.select(*SINK_COLUMNS)
