"""Click-through ratio."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def ctr(impressions: Column, clicks: Column) -> Column:
    """0.0 when there are no impressions, else clicks / impressions (may
    exceed 1; clicks are kept as they are)."""
    return F.when(impressions == 0, F.lit(0.0)).otherwise(
        clicks.cast("double") / impressions.cast("double"))
