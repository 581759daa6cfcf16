"""V1-V6: every rule an event breaks, as (rule, message) pairs."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from clickrate.functions.validity import has_product_id, is_known_type

# The limits of the timestamp rules.
FUTURE_MS = 60_000
OLD_MS = 7 * 86_400_000
# Rule names, and those that report a missing field.
RULES = ("user_id", "product_id", "event_type", "future_timestamp", "old_timestamp", "unknown_type")
MISSING = RULES[:3]


def not_blank(text: Column) -> Column:
    """Not null and not white space only (V1-V3; the test of P4 on any field)."""
    return has_product_id(text)


def violations(user_id: Column, product_id: Column, event_type: Column, timestamp_ms: Column, as_of_ms: Column) -> Column:
    """Array of (rule, message), in rule order; empty for a valid event.  All rules are tested:
    a missing type is both missing and unknown.  A null timestamp breaks none."""
    def text(c):
        return F.coalesce(c.cast("string"), F.lit("null"))

    tests = (
        (~not_blank(user_id), F.lit("userId is required")),
        (~not_blank(product_id), F.lit("productId is required")),
        (~not_blank(event_type), F.lit("eventType is required")),
        # compared on the side of as_of: the timestamp may be near the ends of 64 bits
        (timestamp_ms > as_of_ms + FUTURE_MS, F.concat(F.lit("timestamp is in the future: "), text(timestamp_ms), F.lit(" > "), text(as_of_ms))),
        (timestamp_ms < as_of_ms - OLD_MS, F.lit("timestamp is too old (> 7 days)")),
        (~is_known_type(event_type), F.concat(F.lit("invalid eventType: "), text(event_type))),
    )
    found = [F.when(broken, F.struct(F.lit(rule).alias("rule"), message.alias("message"))) for rule, (broken, message) in zip(RULES, tests)]
    return F.array_compact(F.array(*found))
