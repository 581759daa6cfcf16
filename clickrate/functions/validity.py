"""Event validity and kind tests."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from clickrate.functions.timestamps import MAX_ABS_MS

# Accepted event types, and the ones counted as impressions.
VALID_EVENT_TYPES = ("view", "impression", "click")
IMPRESSION_TYPES = ("view", "impression")
CLICK_TYPE = "click"


def has_product_id(product_id: Column) -> Column:
    """Not null and not blank (Unicode white space counts as blank)."""
    return F.coalesce(product_id.rlike(r"(?U)\S"), F.lit(False))


def is_known_type(event_type: Column) -> Column:
    """P5: one of the valid types, case-sensitive."""
    return F.coalesce(event_type.isin(*VALID_EVENT_TYPES), F.lit(False))


def is_valid(product_id: Column, event_type: Column, timestamp_ms: Column) -> Column:
    """Product id, timestamp and type all present and well formed.  The
    timestamp must also be representable as a Spark timestamp (|ms| < 2^63/1000)."""
    return F.coalesce(
        has_product_id(product_id)
        & timestamp_ms.between(-MAX_ABS_MS, MAX_ABS_MS)
        & is_known_type(event_type),
        F.lit(False),
    )


def is_impression(event_type: Column) -> Column:
    """P10."""
    return event_type.isin(*IMPRESSION_TYPES)


def is_click(event_type: Column) -> Column:
    return event_type == F.lit(CLICK_TYPE)
