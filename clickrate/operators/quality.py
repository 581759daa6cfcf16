"""V1-V7: the violation list of every record, and its counts.

Unlike the first-error status of the envelope (P7), a record lists everything that is wrong
with it.  Records that do not decode have no fields to test; they carry the one pair
("undecodable", "Malformed JSON").
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from clickrate.functions.violations import MISSING, violations
from clickrate.operators.parse import parse_payloads

UNDECODABLE = "undecodable"


def validated(raw: DataFrame, as_of_ms: Column) -> DataFrame:
    """The columns of ``raw`` but the payload, ``event`` (null if undecodable) and ``violations``."""
    parsed = parse_payloads(raw, every_event=True)
    e = F.col("event")
    found = violations(e["user_id"], e["product_id"], e["event_type"], e["timestamp"], as_of_ms)
    broken = F.array(F.struct(F.lit(UNDECODABLE).alias("rule"), F.col("error_message").alias("message")))
    keep = [c for c in raw.columns if c != "value"]
    return parsed.select(*keep, "event", F.when(e.isNull(), broken).otherwise(found).alias("violations"))


def validity_summary(rows: DataFrame, keys: tuple[str, ...] = ("source",)) -> DataFrame:
    """V7: the four counters.  One aggregate with partial sums; no list is exploded."""
    rules = F.transform("violations", lambda v: v["rule"])
    missing = F.size(F.filter(rules, lambda r: r.isin(*MISSING)))
    return rows.groupBy(*keys).agg(
        F.count_if(F.size("violations") == 0).alias("valid"), F.count_if(F.size("violations") > 0).alias("invalid"),
        F.count_if(F.array_contains(rules, "future_timestamp")).alias("future_timestamps"), F.sum(missing).cast("long").alias("missing_fields"))


def violation_breakdown(rows: DataFrame, keys: tuple[str, ...] = ("source",)) -> DataFrame:
    """V7: records by broken rule; a record counts once for each rule it breaks."""
    return (rows.select(*keys, F.explode("violations.rule").alias("rule")).groupBy(*keys, "rule").agg(F.count(F.lit(1)).alias("n")))
