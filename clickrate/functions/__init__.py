"""Column-expression building blocks (all JVM-side, no Python UDFs)."""

from clickrate.functions.dlq import dlq_line
from clickrate.functions.ratio import ctr
from clickrate.functions.timekeys import hour_bucket, insert_time, minute_bucket, month_key
from clickrate.functions.timestamps import event_time, with_timestamp_ms
from clickrate.functions.validity import (
    has_product_id, is_click, is_impression, is_known_type, is_valid,
)

__all__ = [
    "ctr", "dlq_line", "event_time", "has_product_id", "hour_bucket", "insert_time",
    "is_click", "is_impression", "is_known_type", "is_valid", "minute_bucket",
    "month_key", "with_timestamp_ms",
]
