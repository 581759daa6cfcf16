"""The exact emission sequence of a tumbling window with allowed lateness.

Reference behaviour: a window fires once when the watermark passes its end
(on time), then once more for every late element that arrives before the
window is closed (end + lateness); later elements are dropped.  Spark's
built-in window aggregate has no per-element late firing, so this operator
is a grouped state function keyed by (product_id, window_end):

* the watermark delay is window + out-of-orderness + lateness, so Spark's
  own late-row filter (by a row's event time) never drops a row the
  reference would still accept; the real bounds are applied here:
  on time when watermark >= end - window - lateness, closed when
  watermark >= end - window (both in the delayed watermark's terms);
* state per key is (impressions, clicks, fired); the event-time timeout is
  set to the on-time point, then to the closing point, then state goes.

State is one small row per open window, so it is bounded by the number of
(product, window) pairs inside the lateness horizon, like the built-in
window state.  Rows of one key and batch are processed in order of event
time and type.
"""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from clickrate.functions.validity import CLICK_TYPE, IMPRESSION_TYPES
from clickrate.operators.parse import parse_payloads, valid_events
from clickrate.operators.union import union_events
from clickrate.operators.window_agg import with_event_time
from clickrate.streaming.job import WindowSettings

FIRE_SCHEMA = ("product_id string, window_start long, window_end long, impressions long, "
               "clicks long, ctr double, fire string, event_time_ms long")
STATE_SCHEMA = "impressions long, clicks long, fired boolean"

ON_TIME, LATE = "on_time", "late"


def _fire_fn(settings: WindowSettings):
    w = settings.window_s * 1000
    lateness = settings.allowed_lateness_s * 1000
    delay = w + (settings.out_of_orderness_s + settings.allowed_lateness_s) * 1000

    def row(pid, end, imps, clks, kind, t):
        return (pid, end - w, end, imps, clks, 0.0 if imps == 0 else clks / imps, kind, t)

    def fn(key, pdfs: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        pid, end = key[0], int(key[1])
        wm = state.getCurrentWatermarkMs()
        on_time_at = end - w - lateness      # watermark value of "max event time >= end + ooo"
        close_at = end - w                   # watermark value of "max event time >= end + ooo + lateness"
        out = []
        if state.hasTimedOut:
            imps, clks, fired = (int(v) if i < 2 else bool(v) for i, v in enumerate(state.get))
            if not fired:
                out.append(row(pid, end, imps, clks, ON_TIME, None))
            if wm >= close_at:
                state.remove()
            else:
                state.update((imps, clks, True))
                state.setTimeoutTimestamp(close_at - 1)
        else:
            data = pd.concat(list(pdfs), ignore_index=True).sort_values(["timestamp", "event_type"], kind="stable")
            imps, clks, fired = ((int(state.get[0]), int(state.get[1]), bool(state.get[2]))
                                 if state.exists else (0, 0, False))
            # The on-time row comes first: the watermark may pass both points
            # in one batch, and a late row must not remove an unfired window.
            if state.exists and not fired and wm >= on_time_at:
                out.append(row(pid, end, imps, clks, ON_TIME, None))
                fired = True
            if wm >= close_at:               # window closed: late rows vanish
                if state.exists:
                    state.remove()
                data = data.iloc[:0]
            for etype, t in zip(data["event_type"], data["timestamp"]):
                imps += int(etype in IMPRESSION_TYPES)
                clks += int(etype == CLICK_TYPE)
                if fired or wm >= on_time_at:
                    out.append(row(pid, end, imps, clks, LATE, int(t)))
                    fired = True
            if wm < close_at:
                state.update((imps, clks, fired))
                state.setTimeoutTimestamp((close_at if fired else on_time_at) - 1)
        if not out:
            return iter([])
        return iter([pd.DataFrame(out, columns=["product_id", "window_start", "window_end", "impressions",
                                                "clicks", "ctr", "fire", "event_time_ms"])])

    return fn, delay


def fire_log_stream(impressions_raw: DataFrame, clicks_raw: DataFrame,
                    settings: WindowSettings = WindowSettings()) -> DataFrame:
    fn, delay = _fire_fn(settings)
    w = settings.window_s * 1000

    def side(raw):
        ev = with_event_time(valid_events(parse_payloads(raw)))
        return ev.withWatermark("event_time", f"{delay // 1000} seconds")

    events = union_events(side(impressions_raw), side(clicks_raw))
    keyed = events.select(
        "product_id", "event_type", "timestamp", "event_time",
        (F.col("timestamp") - F.pmod(F.col("timestamp"), F.lit(w)) + F.lit(w)).alias("window_end"))
    return keyed.groupBy("product_id", "window_end").applyInPandasWithState(
        fn, FIRE_SCHEMA, STATE_SCHEMA, "append", GroupStateTimeout.EventTimeTimeout)
