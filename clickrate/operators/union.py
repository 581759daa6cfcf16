"""Bag union of the two event streams, then the product-id filter."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from clickrate.functions.validity import has_product_id


def union_events(*streams: DataFrame) -> DataFrame:
    """Keeps duplicates; the event kind comes from ``event_type``, not from the
    source.  Works on batch and streaming frames (watermarks combine with the
    session's multiple-watermark policy, min by default)."""
    merged = reduce(lambda a, b: a.unionByName(b), streams)
    # implied by validity already, kept as the job's own second check.
    return merged.filter(has_product_id(F.col("product_id")))
