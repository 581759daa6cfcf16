"""Window counts whose state expires by processing time.

The built-in window state goes when the watermark passes, so a source whose event times stand
still keeps its windows for ever.  Here a (product, window) whose counts were not changed for
``ttl_s`` seconds of processing time leaves the state, whatever the watermark does.  Rows that
come after that start a new count, and an expired count is never used, also not between its
expiry and the batch that removes it: every write stores its time, and it is compared again
when rows arrive.  Emits the running row of each window that a batch changes (update mode);
``fresh`` marks a count that began, or began again, in that batch.

Run it with a processing-time trigger.  A state with processing-time timeouts always wants another
batch, so ``availableNow`` only ends with ``spark.sql.streaming.noDataMicroBatches.enabled=false``.
"""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from clickrate.functions.validity import is_click, is_impression
from clickrate.operators.parse import parse_payloads, valid_events
from clickrate.operators.union import union_events

COUNT_SCHEMA = "product_id string, window_start long, window_end long, impressions long, clicks long, ctr double, fresh boolean"
STATE_SCHEMA = "impressions long, clicks long, written_ms long"


def _counts_fn(window_ms: int, ttl_ms: int):
    def fn(key, pdfs: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        if state.hasTimedOut:
            state.remove()
            return
        now = state.getCurrentProcessingTimeMs()
        imps, clks, written = (int(v) for v in state.get) if state.exists else (0, 0, None)
        fresh = written is None or now - written >= ttl_ms
        if fresh:
            imps = clks = 0
        for rows in pdfs:
            imps, clks = imps + int(rows["impressions"].sum()), clks + int(rows["clicks"].sum())
        state.update((imps, clks, now))
        state.setTimeoutDuration(ttl_ms)
        start = int(key[1])
        yield pd.DataFrame({"product_id": [key[0]], "window_start": [start], "window_end": [start + window_ms], "impressions": [imps], "clicks": [clks],
                            "ctr": [0.0 if imps == 0 else clks / imps], "fresh": [fresh]})
    return fn


def retained_counts(*raws: DataFrame, window_s: int = 10, ttl_s: float = 24 * 3600.0) -> DataFrame:
    """The stream of window counts over the union of ``raws``."""
    events = union_events(*(valid_events(parse_payloads(raw)) for raw in raws))
    w = window_s * 1000
    keyed = events.select("product_id", (F.col("timestamp") - F.pmod("timestamp", F.lit(w))).alias("window_start"),
                          is_impression(F.col("event_type")).cast("int").alias("impressions"), is_click(F.col("event_type")).cast("int").alias("clicks"))
    return keyed.groupBy("product_id", "window_start").applyInPandasWithState(
        _counts_fn(w, int(ttl_s * 1000)), COUNT_SCHEMA, STATE_SCHEMA, "update", GroupStateTimeout.ProcessingTimeTimeout)
