"""Registered queries (one per operator group) and their DuckDB oracles.

Every query reads the driver's ``events`` table (through the payload
adapter) and runs the whole pipeline on all of it.  Window bounds and other
times are returned as epoch ms and averages rounded to 9 digits, so the
Spark result and the oracle compare exactly.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from clickrate.operators import queries as Q
from clickrate.operators import rollups as R
from clickrate.operators.monitoring import active_products, invalid_rate_alerts
from clickrate.operators.parse import parse_payloads, valid_events
from clickrate.operators.union import union_events
from clickrate.operators.window_agg import count_exprs, merge_counts, window_counts, with_event_time, with_ratio
from clickrate.plans import monitoring, stored
from clickrate.plans.batch import batch_ctr, events_to_parsed
from clickrate.session import configure, shared_dir
from clickrate.sinks.tables import to_raw_rows, write_raw_table
from clickrate.sources.events_adapter import load_events, raw_streams, shaped_records
from clickrate.sources.result_table import newest_end_ms, read_raw_table

HISTORY_PRODUCT = "product7"
REPLAY_STEPS = 4
ROUND = 9


def _ms(col: str) -> F.Column:
    return F.unix_millis(F.col(col)).alias(col)


def _ctr10(spark, sf):
    return batch_ctr(spark, sf, "10 seconds")


def _raw_rows(spark, sf) -> DataFrame:
    """CTR rows shaped as the stored table (timestamp bounds)."""
    return R.as_timestamps(_ctr10(spark, sf))


# --- parse / split -------------------------------------------------------

def parsed_valid_events(spark, sf):
    return events_to_parsed(spark, sf).valid().select(
        "source", "event_id", "event_type", "product_id", "user_id", "timestamp")


def dlq_events(spark, sf):
    return events_to_parsed(spark, sf).dlq().select("source", "error_message", "line")


def validity_counts(spark, sf):
    parsed = events_to_parsed(spark, sf).parsed
    return (parsed.groupBy("source", F.coalesce("error_message", F.lit("valid")).alias("status"))
            .agg(F.count(F.lit(1)).alias("n")))


def union_events_q(spark, sf):
    configure(spark)
    imps, clks = raw_streams(load_events(spark, sf))
    u = union_events(valid_events(parse_payloads(imps)), valid_events(parse_payloads(clks)))
    return u.select("source", "product_id", "event_type", "timestamp")


def payload_shapes(spark, sf):
    """P1, P2, P7 on the rarer payload shapes, one for each event."""
    configure(spark)
    parsed = parse_payloads(shaped_records(load_events(spark, sf)))
    return parsed.select("event_id", "event.product_id", "event.timestamp", "error_message")


# --- windowed CTR --------------------------------------------------------

def ctr_10s(spark, sf):
    return _ctr10(spark, sf)


def ctr_1h(spark, sf):
    return batch_ctr(spark, sf, "1 hour")


def ctr_1d_mod5(spark, sf):
    return batch_ctr(spark, sf, "1 day", product_buckets=5)


def ctr_partial_merge(spark, sf):
    """A2: each source counted on its own (partial count pairs), then merged."""
    configure(spark)
    imps, clks = raw_streams(load_events(spark, sf))
    parts = []
    for raw in (imps, clks):
        counts = window_counts(with_event_time(valid_events(parse_payloads(raw))), "1 hour", count_exprs())
        parts.append(counts.select("product_id", "impressions", "clicks",
                                   F.unix_millis("window.start").alias("window_start"),
                                   F.unix_millis("window.end").alias("window_end")))
    merged = merge_counts(parts[0].unionByName(parts[1]))
    return with_ratio(merged).select("product_id", "impressions", "clicks", "ctr", "window_start", "window_end")


# --- rollups -------------------------------------------------------------

def _minute_out(df: DataFrame) -> DataFrame:
    return df.select("product_id", _ms("window_minute"), F.round("avg_ctr", ROUND).alias("avg_ctr"),
                     "total_impressions", "total_clicks", _ms("latest_window"))


def minute_rollup(spark, sf):
    return _minute_out(R.minute_rollup(_raw_rows(spark, sf)))


def minute_rollup_merged_states(spark, sf):
    """A5: rows split into three insert blocks (round robin over windows);
    states are built per block, then merged and finished."""
    rows = _raw_rows(spark, sf).withColumn(
        "block", F.pmod((F.unix_millis("window_start") / 10000).cast("long"), F.lit(3)))
    parts = R.minute_parts(rows, extra_keys=("block",)).drop("block")
    return _minute_out(R.finish_minute(parts))


def minute_series_last_10m(spark, sf):
    rows = _raw_rows(spark, sf)
    view = R.finish_minute(R.minute_parts(rows))
    series = Q.minute_series(view, minutes=10, as_of_rows=rows)
    return series.select("product_id", _ms("window_minute"), F.round("avg_ctr", ROUND).alias("avg_ctr"))


def _latest_out(df: DataFrame) -> DataFrame:
    return df.select("product_id", "latest_ctr", "latest_impressions", "latest_clicks", _ms("window_end"))


def latest_per_product(spark, sf):
    return _latest_out(R.latest_per_product(_raw_rows(spark, sf)))


def latest_per_product_argmax(spark, sf):
    return _latest_out(R.latest_per_product_argmax(_raw_rows(spark, sf)))


def latest_top10(spark, sf):
    latest = R.latest_per_product(_raw_rows(spark, sf))
    return _latest_out(Q.top_recent(latest, 10))


def recent_windows_top5(spark, sf):
    rows = _raw_rows(spark, sf)
    top = Q.top_recent(rows, 5, ["product_id", "impressions", "clicks", "ctr", "window_end"])
    return top.select("product_id", "impressions", "clicks", "ctr", _ms("window_end"))


def product_history(spark, sf):
    return Q.product_history(_ctr10(spark, sf), HISTORY_PRODUCT)


def last_hour(spark, sf):
    rows = _raw_rows(spark, sf)
    return Q.last_hour(rows).select("product_id", "ctr", "impressions", "clicks",
                                    _ms("window_start"), _ms("window_end"))


def avg_ctr_24h(spark, sf):
    out = Q.avg_ctr_since(_raw_rows(spark, sf), 86_400)
    return out.select("product_id", F.round("avg_ctr", ROUND).alias("avg_ctr"))


def result_count(spark, sf):
    return Q.row_count(_ctr10(spark, sf))


def month_partition_roundtrip(spark, sf):
    """K3 + S6: write the month-partitioned table, read it back."""
    path = shared_dir(spark, "ctr_results_raw")
    write_raw_table(to_raw_rows(_ctr10(spark, sf)), path)
    back = read_raw_table(spark, path)
    return back.select("product_id", "ctr", "impressions", "clicks",
                       _ms("window_start"), _ms("window_end"), "window_month")


# --- streaming (file replay of the whole table) -------------------------

_REPLAYS: dict = {}
WINDOW_6H = 21_600
HELD_EVERY = 7
FRESH_FROM = 2


def _replay(spark, sf, name: str = "plain", window_s: int | None = None, **kw):
    """One replay per application, table and name, shared by the stream queries."""
    from clickrate.streaming.job import WindowSettings
    from clickrate.streaming.replay import replay_events

    key = (spark.sparkContext.applicationId, sf, name)
    if key not in _REPLAYS:
        settings = WindowSettings(window_s=window_s) if window_s else WindowSettings()
        _REPLAYS[key] = replay_events(spark, sf, REPLAY_STEPS, settings, **kw)
    return _REPLAYS[key]


def refire_double_count(spark, sf):
    """1 day windows (five products) replayed in steps whose cuts split
    windows, so update
    mode emits a split window twice.  The minute rollup of the emission log
    (what a view fed by every emitted row shows) counts such windows twice;
    the rollup of final rows does not."""
    tables = _replay(spark, sf, "refire", 86_400, with_dlq=False, product_buckets=5).tables
    cols = ["product_id", "impressions", "clicks", "window_end"]
    tagged = (tables.emission_log().select(*cols, F.lit(True).alias("is_log"))
              .unionByName(tables.final_rows().select(*cols, F.lit(False).alias("is_log"))))
    minute = (F.col("window_end") - F.pmod("window_end", F.lit(60_000))).alias("window_minute")

    def total(col, is_log):
        return F.sum(F.when(F.col("is_log") == is_log, F.col(col)).otherwise(0)).cast("long")

    return tagged.groupBy("product_id", minute).agg(
        total("impressions", True).alias("log_impressions"), total("clicks", True).alias("log_clicks"),
        total("impressions", False).alias("final_impressions"), total("clicks", False).alias("final_clicks"))


def stream_ctr_final(spark, sf):
    """File streams run to the end; final row per window (K2 read side)."""
    return _final(_replay(spark, sf))


def _final(replay) -> DataFrame:
    return replay.tables.final_rows().select("product_id", "impressions", "clicks", "ctr", "window_start", "window_end")


def stream_late_rows(spark, sf):
    """Every seventh event comes one step late.  It counts only in
    windows that the watermark (slower source's newest event - 10 s) has not closed."""
    return _final(_replay(spark, sf, "late", WINDOW_6H, with_dlq=False, product_buckets=5, held_every=HELD_EVERY))


def stream_append_final(spark, sf):
    """K1: append mode with the same late rows; one row per window that has closed."""
    return _final(_replay(spark, sf, "append", WINDOW_6H, with_dlq=False, product_buckets=5, held_every=HELD_EVERY,
                          output_mode="append"))


def stream_restart_final(spark, sf):
    """The third step starts on a fresh checkpoint: earlier rows stay, and a window
    that the cut splits shows the newer run's row."""
    return _final(_replay(spark, sf, "restart", WINDOW_6H, with_dlq=False, product_buckets=5, fresh_from=FRESH_FROM))


def stream_stored_last_day(spark, sf):
    """F6 on the table that the stream wrote: emitted rows of the last day, re-fired ones included."""
    path = _replay(spark, sf, "restart", WINDOW_6H, with_dlq=False, product_buckets=5, fresh_from=FRESH_FROM).tables.path("final")
    newest = newest_end_ms(spark, path) or 0
    rows = read_raw_table(spark, path, start_ms=newest - 86_400_000)
    return rows.select("product_id", "ctr", "impressions", "clicks", _ms("window_start"), _ms("window_end"))


def stream_dlq_events(spark, sf):
    """K6: the dead-letter table written by the DLQ stream."""
    return spark.read.parquet(_replay(spark, sf).dlq_path).select("source", "error_message", "line")


def stream_minute_rollup(spark, sf):
    """K4: minute rollup merged from the per-batch delta states."""
    return _minute_out(_replay(spark, sf).tables.minute_view())


def stream_latest_per_product(spark, sf):
    """K5: latest row per product merged from the per-batch partials."""
    return _latest_out(_replay(spark, sf).tables.latest_view())


FIRE_LATENESS_S = 9 * 86_400


def stream_fire_log(spark, sf):
    """The emission sequence of 6 h windows, every seventh event one step late.  ``nr`` is an
    emission's place among its window's."""
    from clickrate.streaming.job import WindowSettings
    from clickrate.streaming.replay import replay_fire_log

    key = (spark.sparkContext.applicationId, sf, "fire")
    if key not in _REPLAYS:
        settings = WindowSettings(window_s=WINDOW_6H, allowed_lateness_s=FIRE_LATENESS_S)
        _REPLAYS[key] = replay_fire_log(spark, sf, REPLAY_STEPS, settings, product_buckets=5, held_every=HELD_EVERY)
    log = spark.read.parquet(_REPLAYS[key])
    nr = F.row_number().over(W.partitionBy("product_id", "window_start").orderBy((F.col("fire") == "late"), F.col("impressions") + F.col("clicks")))
    return log.select("product_id", "window_start", "window_end", nr.alias("nr"), "fire", "impressions", "clicks", "ctr", "event_time_ms")


def stream_dropped_rows(spark, sf):
    """Valid rows that each step delivered, that its windows took, and that came too late,
    from the table of micro-batches."""
    from clickrate.streaming.progress import drops_by_batch

    replay = _replay(spark, sf, "late", WINDOW_6H, with_dlq=False, product_buckets=5, held_every=HELD_EVERY)
    batches = drops_by_batch(replay.progress.read(), replay.tables.emission_log()).filter("rows_in > 0")
    step = F.row_number().over(W.orderBy("batch_id")) - 1  # one row a batch
    return batches.select(step.alias("step"), "rows_in", "counted", "dropped")


def stream_active_products(spark, sf):
    """Products with results on each day, from the sketches that every batch wrote."""
    parts = _replay(spark, sf).tables.activity()
    return active_products(parts, F.date_trunc("day", "window_minute"), "day").select(_ms("day"), "active_products")


def stream_invalid_rate_alerts(spark, sf):
    """V9: the alerts from the table that a stream of the records wrote, delivered in steps."""
    from clickrate.streaming.replay import replay_status

    key = (spark.sparkContext.applicationId, sf, "status")
    if key not in _REPLAYS:
        _REPLAYS[key] = replay_status(spark, sf, REPLAY_STEPS)
    from clickrate.streaming.health import read_status
    return invalid_rate_alerts(read_status(spark, _REPLAYS[key]))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "parsed_valid_events": parsed_valid_events,
    "dlq_events": dlq_events,
    "validity_counts": validity_counts,
    "union_events": union_events_q,
    "ctr_10s": ctr_10s,
    "ctr_1h": ctr_1h,
    "ctr_1d_mod5": ctr_1d_mod5,
    "ctr_partial_merge": ctr_partial_merge,
    "minute_rollup": minute_rollup,
    "minute_rollup_merged_states": minute_rollup_merged_states,
    "minute_series_last_10m": minute_series_last_10m,
    "latest_per_product": latest_per_product,
    "latest_per_product_argmax": latest_per_product_argmax,
    "latest_top10": latest_top10,
    "recent_windows_top5": recent_windows_top5,
    "product_history": product_history,
    "last_hour": last_hour,
    "avg_ctr_24h": avg_ctr_24h,
    "result_count": result_count,
    "month_partition_roundtrip": month_partition_roundtrip,
    "stream_ctr_final": stream_ctr_final,
    "stream_dlq_events": stream_dlq_events,
    "stream_minute_rollup": stream_minute_rollup,
    "stream_latest_per_product": stream_latest_per_product,
    "refire_double_count": refire_double_count,
    "payload_shapes": payload_shapes,
    "stream_late_rows": stream_late_rows,
    "stream_append_final": stream_append_final,
    "stream_restart_final": stream_restart_final,
    "stream_stored_last_day": stream_stored_last_day,
    "stream_fire_log": stream_fire_log,
    "stream_dropped_rows": stream_dropped_rows,
    "stream_active_products": stream_active_products,
    "stream_invalid_rate_alerts": stream_invalid_rate_alerts,
    **stored.QUERIES,
    **monitoring.QUERIES,
}


# --- DuckDB oracles ------------------------------------------------------

def _events_cte(product_expr: str = "'product' || json_extract_string(props, '$.k')") -> str:
    return f"""ev AS (
  SELECT event_id, event_type, CAST(user_id AS VARCHAR) AS user_id, ts,
         {product_expr} AS product_id,
         epoch_us(ts) // 1000 AS ts_ms,
         CASE WHEN event_type = 'click' THEN 'Click' ELSE 'Impression' END AS source,
         CASE WHEN event_type = 'error' THEN 'Malformed JSON'
              WHEN event_type NOT IN ('view', 'impression', 'click') THEN 'Invalid event data'
         END AS error_message
  FROM events
)"""


def _ctr_sql(window_ms: int, product_expr: str | None = None) -> str:
    cte = _events_cte(product_expr) if product_expr else _events_cte()
    return f"""WITH {cte},
w AS (
  SELECT product_id, event_type, (ts_ms // {window_ms}) * {window_ms} AS window_start
  FROM ev WHERE error_message IS NULL
),
c AS (
  SELECT product_id, window_start,
         CAST(count(*) FILTER (WHERE event_type IN ('view', 'impression')) AS BIGINT) AS impressions,
         CAST(count(*) FILTER (WHERE event_type = 'click') AS BIGINT) AS clicks
  FROM w GROUP BY product_id, window_start
)
SELECT product_id, impressions, clicks,
       CASE WHEN impressions = 0 THEN 0.0 ELSE clicks::DOUBLE / impressions END AS ctr,
       window_start, window_start + {window_ms} AS window_end
FROM c"""


CTR10_SQL = _ctr_sql(10_000)
MOD5_PRODUCT = "'product' || (CAST(json_extract_string(props, '$.k') AS BIGINT) % 5)"


def _over_ctr10(body: str) -> str:
    return f"WITH ctr AS ({CTR10_SQL})\n{body}"


_PAYLOAD_SQL = """'{"event_id":"' || event_id || '","event_type":"' || event_type
  || '","product_id":"' || product_id || '","user_id":"' || user_id || '","timestamp":'
  || CASE event_id % 3 WHEN 0 THEN CAST(ts_ms AS VARCHAR)
                       WHEN 1 THEN '"' || CAST(ts_ms AS VARCHAR) || '"'
                       ELSE '"' || strftime(epoch_ms(ts_ms), '%Y-%m-%dT%H:%M:%S.%g') || 'Z"' END
  || '}'"""

_MINUTE_SQL = """SELECT product_id, (window_end // 60000) * 60000 AS window_minute,
       round(avg(ctr), 9) AS avg_ctr,
       CAST(sum(impressions) AS BIGINT) AS total_impressions,
       CAST(sum(clicks) AS BIGINT) AS total_clicks,
       max(window_end) AS latest_window
FROM ctr GROUP BY 1, 2"""

_LATEST_SQL = """SELECT product_id, arg_max(ctr, window_end) AS latest_ctr,
       arg_max(impressions, window_end) AS latest_impressions,
       arg_max(clicks, window_end) AS latest_clicks, max(window_end) AS window_end
FROM ctr GROUP BY product_id"""

ORACLE_SQL: dict[str, str] = {
    "parsed_valid_events": f"""WITH {_events_cte()}
SELECT source, CAST(event_id AS VARCHAR) AS event_id, event_type, product_id, user_id, ts_ms AS "timestamp"
FROM ev WHERE error_message IS NULL""",
    "dlq_events": f"""WITH {_events_cte()},
p AS (SELECT source, error_message, {_PAYLOAD_SQL} AS payload FROM ev WHERE error_message IS NOT NULL)
SELECT source, error_message,
       'DLQ [' || source || ']: ' || error_message || ', Data: '
       || CASE WHEN error_message = 'Malformed JSON' THEN left(payload, length(payload) - 1) ELSE payload END AS line
FROM p""",
    "validity_counts": f"""WITH {_events_cte()}
SELECT source, coalesce(error_message, 'valid') AS status, count(*) AS n FROM ev GROUP BY 1, 2""",
    "union_events": f"""WITH {_events_cte()}
SELECT source, product_id, event_type, ts_ms AS "timestamp" FROM ev WHERE error_message IS NULL""",
    "ctr_10s": CTR10_SQL,
    "ctr_1h": _ctr_sql(3_600_000),
    "ctr_1d_mod5": _ctr_sql(86_400_000, MOD5_PRODUCT),
    "ctr_partial_merge": _ctr_sql(3_600_000),
    "minute_rollup": _over_ctr10(_MINUTE_SQL),
    "minute_rollup_merged_states": _over_ctr10(_MINUTE_SQL),
    "minute_series_last_10m": _over_ctr10(f"""SELECT product_id, window_minute, avg_ctr FROM ({_MINUTE_SQL}) m
WHERE window_minute >= (SELECT max(window_end) FROM ctr) - 600000
ORDER BY product_id, window_minute LIMIT 20"""),
    "latest_per_product": _over_ctr10(_LATEST_SQL),
    "latest_per_product_argmax": _over_ctr10(_LATEST_SQL),
    "latest_top10": _over_ctr10(f"""SELECT * FROM ({_LATEST_SQL}) l ORDER BY window_end DESC, product_id LIMIT 10"""),
    "recent_windows_top5": _over_ctr10("""SELECT product_id, impressions, clicks, ctr, window_end FROM ctr
ORDER BY window_end DESC, product_id LIMIT 5"""),
    "product_history": _over_ctr10(f"""SELECT product_id, impressions, clicks, ctr, window_start, window_end
FROM ctr WHERE product_id = '{HISTORY_PRODUCT}' ORDER BY window_end DESC"""),
    "last_hour": _over_ctr10("""SELECT product_id, ctr, impressions, clicks, window_start, window_end FROM ctr
WHERE window_end >= (SELECT max(window_end) FROM ctr) - 3600000"""),
    "avg_ctr_24h": _over_ctr10("""SELECT product_id, round(avg(ctr), 9) AS avg_ctr FROM ctr
WHERE window_end >= (SELECT max(window_end) FROM ctr) - 86400000 GROUP BY product_id"""),
    "result_count": _over_ctr10("SELECT count(*) AS n FROM ctr"),
    "month_partition_roundtrip": _over_ctr10("""SELECT product_id, ctr, impressions, clicks, window_start, window_end,
       CAST(strftime(epoch_ms(window_end), '%Y%m') AS INTEGER) AS window_month FROM ctr"""),
}
ORACLE_SQL["stream_ctr_final"] = CTR10_SQL
ORACLE_SQL["stream_dlq_events"] = ORACLE_SQL["dlq_events"]
ORACLE_SQL["stream_minute_rollup"] = ORACLE_SQL["minute_rollup"]
ORACLE_SQL["stream_latest_per_product"] = ORACLE_SQL["latest_per_product"]
ORACLE_SQL["refire_double_count"] = f"""WITH {_events_cte(MOD5_PRODUCT)},
b AS (SELECT min(ts_ms) AS lo, max(ts_ms) AS hi FROM ev),
p AS (
  SELECT ev.*, least(greatest((ts_ms - b.lo) // ((b.hi - b.lo + {REPLAY_STEPS}) // {REPLAY_STEPS}), 0),
                     {REPLAY_STEPS - 1}) AS step
  FROM ev, b WHERE error_message IS NULL
),
w AS (
  SELECT product_id, step, (ts_ms // 86400000) * 86400000 AS window_start,
         count(*) FILTER (WHERE event_type IN ('view', 'impression')) AS imps,
         count(*) FILTER (WHERE event_type = 'click') AS clks
  FROM p GROUP BY 1, 2, 3
),
em AS (
  SELECT product_id, window_start,
         sum(imps) OVER (PARTITION BY product_id, window_start ORDER BY step) AS ci,
         sum(clks) OVER (PARTITION BY product_id, window_start ORDER BY step) AS cc,
         imps, clks
  FROM w
)
SELECT product_id, window_start + 86400000 AS window_minute,
       CAST(sum(ci) AS BIGINT) AS log_impressions, CAST(sum(cc) AS BIGINT) AS log_clicks,
       CAST(sum(imps) AS BIGINT) AS final_impressions, CAST(sum(clks) AS BIGINT) AS final_clicks
FROM em GROUP BY 1, 2"""

ORACLE_SQL["payload_shapes"] = """WITH e AS (
  SELECT event_id, event_type, json_extract_string(props, '$.k') AS k, event_id % 10 AS shape, epoch_us(ts) // 1000 AS ms
  FROM events
),
f AS (
  SELECT *, CASE WHEN shape IN (2, 4, 9) THEN 'Malformed JSON'
                 WHEN shape IN (3, 5) OR event_type NOT IN ('view', 'impression', 'click') THEN 'Invalid event data'
            END AS error_message
  FROM e
)
SELECT event_id, error_message,
       CASE WHEN error_message IS NOT NULL THEN NULL
            WHEN shape = 0 THEN k || '.50'
            WHEN shape = 1 THEN repeat('1', 20) || lpad(k, 21, '0')
            ELSE 'product' || k END AS product_id,
       CASE WHEN error_message IS NOT NULL THEN NULL
            WHEN shape = 6 THEN ms // 1000 * 1000
            WHEN shape = 8 THEN -62167219200000
            ELSE ms END AS "timestamp"
FROM f"""


def _over_store(body: str) -> str:
    return f"WITH ctr AS ({_ctr_sql(stored.WINDOW_MS, MOD5_PRODUCT)})\n{body}"


_DAY_SQL = "window_end >= (SELECT max(window_end) FROM ctr) - 86400000"
_CTR_COLUMNS = "product_id, ctr, impressions, clicks, window_start, window_end"
_AVG_DAY_SQL = f"SELECT product_id, round(avg(ctr), 9) AS avg_ctr FROM ctr WHERE {_DAY_SQL} GROUP BY product_id"
ORACLE_SQL |= {
    "stored_count": _over_store("SELECT count(*) AS n FROM ctr"),
    "stored_last_day": _over_store(f"SELECT {_CTR_COLUMNS} FROM ctr WHERE {_DAY_SQL}"),
    "stored_avg_ctr_24h": _over_store(_AVG_DAY_SQL),
    "stored_avg_ctr_24h_rollup": _over_store(_AVG_DAY_SQL),
    "stored_minute_rollup": _over_store(_MINUTE_SQL),
    "stored_minute_series": _over_store(f"""SELECT product_id, window_minute, avg_ctr FROM ({_MINUTE_SQL}) m
WHERE window_minute >= (SELECT max(window_end) FROM ctr) - 86400000 ORDER BY product_id, window_minute LIMIT 20"""),
    "stored_latest_top10": _over_store(f"SELECT * FROM ({_LATEST_SQL}) l ORDER BY window_end DESC, product_id LIMIT 10"),
    "stored_latest_lookup": _over_store(f"SELECT * FROM ({_LATEST_SQL}) l WHERE product_id = '{stored.PRODUCT}'"),
    "stored_recent_top5": _over_store("""SELECT product_id, impressions, clicks, ctr, window_end FROM ctr
ORDER BY window_end DESC, product_id LIMIT 5"""),
    "stored_product_history": _over_store(f"""SELECT product_id, impressions, clicks, ctr, window_start, window_end
FROM ctr WHERE product_id = '{stored.PRODUCT}'"""),
}
ORACLE_SQL |= {
    "stored_sink_columns": _over_store("SELECT product_id, ctr, impressions, clicks, window_start, window_end FROM ctr"),
    "stored_insert_times": _over_store("SELECT TRUE AS whole_ms, TRUE AS recent, count(*) AS n FROM ctr"),
    "stored_order": _over_store("SELECT CAST(0 AS BIGINT) AS out_of_order, count(*) AS n FROM ctr"),
    "stored_sample": _over_store("SELECT least(count(*), 100) AS n, least(count(*), 100) AS known FROM ctr"),
    "stored_export": _over_store("SELECT product_id, ctr, impressions, clicks, window_start, window_end FROM ctr"),
}

_6H_MS = WINDOW_6H * 1000
# Valid events with their slice and delivery step; the watermark a step starts with.
_STEPS_SQL = f"""WITH {_events_cte(MOD5_PRODUCT)},
b AS (SELECT min(ts_ms) AS lo, (max(ts_ms) - min(ts_ms) + {REPLAY_STEPS}) // {REPLAY_STEPS} AS width FROM ev),
p AS (
  SELECT ev.*, ts_ms // {_6H_MS} * {_6H_MS} AS window_start,
         least((ts_ms - lo) // width, {REPLAY_STEPS - 1}) AS slice,
         least((ts_ms - lo) // width, {REPLAY_STEPS - 1}) + CASE WHEN event_id % {HELD_EVERY} = 0 THEN 1 ELSE 0 END AS step
  FROM ev, b WHERE error_message IS NULL
),
wm AS (
  SELECT s.step, least((SELECT max(ts_ms) FROM p WHERE source = 'Click' AND p.step < s.step),
                       (SELECT max(ts_ms) FROM p WHERE source = 'Impression' AND p.step < s.step)) - 10000 AS mark
  FROM range({REPLAY_STEPS + 2}) s(step)
)"""
_COUNTS = """CAST(count(*) FILTER (WHERE event_type IN ('view', 'impression')) AS BIGINT) AS impressions,
         CAST(count(*) FILTER (WHERE event_type = 'click') AS BIGINT) AS clicks"""
_CTR_OF_C = f"""SELECT product_id, impressions, clicks,
       CASE WHEN impressions = 0 THEN 0.0 ELSE clicks::DOUBLE / impressions END AS ctr,
       window_start, window_start + {_6H_MS} AS window_end
FROM c"""
_LATE_SQL = f"""{_STEPS_SQL},
c AS (
  SELECT product_id, window_start, {_COUNTS}
  FROM p JOIN wm USING (step) WHERE mark IS NULL OR window_start + {_6H_MS} > mark GROUP BY ALL
)
{_CTR_OF_C}"""
_RESTART_SQL = f"""{_STEPS_SQL},
r AS (SELECT *, slice >= {FRESH_FROM} AS run, max(slice >= {FRESH_FROM}) OVER (PARTITION BY product_id, window_start) AS newest FROM p),
c AS (SELECT product_id, window_start, {_COUNTS} FROM r WHERE run = newest GROUP BY ALL)
{_CTR_OF_C}"""
ORACLE_SQL |= {
    "stream_late_rows": _LATE_SQL,
    "stream_append_final": f"""{_LATE_SQL} WHERE window_start + {_6H_MS} <= (SELECT mark FROM wm WHERE step = {REPLAY_STEPS + 1})""",
    "stream_restart_final": _RESTART_SQL,
    "stream_stored_last_day": f"""SELECT {_CTR_COLUMNS} FROM ({_RESTART_SQL}) f
WHERE window_end >= (SELECT max(ts_ms) // {_6H_MS} * {_6H_MS} + {_6H_MS} FROM ({_STEPS_SQL} SELECT ts_ms FROM p) v) - 86400000""",
}


def _after_store(body: str) -> str:
    """A query that may go on with further tables of its own."""
    return f"WITH ctr AS ({_ctr_sql(stored.WINDOW_MS, MOD5_PRODUCT)}){body if body.startswith(',') else chr(10) + body}"


ORACLE_SQL |= monitoring.oracles(_after_store)
ORACLE_SQL["stream_active_products"] = _over_ctr10("SELECT window_end // 86400000 * 86400000 AS day, count(DISTINCT product_id) AS active_products FROM ctr GROUP BY 1")
ORACLE_SQL["stream_invalid_rate_alerts"] = ORACLE_SQL["invalid_rate_alerts"]

# Emissions of a window: one with the counts of all rows that came before the slower source
# passed its end by 5 s, then one for each row that came between that and the end of lateness.
_FIRE_SQL = f"""{_STEPS_SQL},
m AS (SELECT step, mark + 10000 AS newest FROM wm),
r AS (
  SELECT p.*, window_start + {_6H_MS} AS window_end, coalesce(newest >= window_start + {_6H_MS} + 5000, FALSE) AS late,
         event_type <> 'click' AS imp
  FROM p JOIN m USING (step) WHERE newest IS NULL OR newest < window_start + {_6H_MS} + 5000 + {FIRE_LATENESS_S * 1000}
),
c AS (
  SELECT *, count(*) FILTER (imp) OVER o AS impressions, count(*) FILTER (NOT imp) OVER o AS clicks
  FROM r WINDOW o AS (PARTITION BY product_id, window_start ORDER BY step, ts_ms, event_type ROWS UNBOUNDED PRECEDING)
),
e AS (
  SELECT product_id, window_start, window_end, 'on_time' AS fire, max(impressions) AS impressions, max(clicks) AS clicks, NULL AS event_time_ms
  FROM c WHERE NOT late GROUP BY ALL HAVING (SELECT max(newest) FROM m) >= window_end + 5000
  UNION ALL
  SELECT product_id, window_start, window_end, 'late', impressions, clicks, ts_ms FROM c WHERE late
)
SELECT product_id, window_start, window_end, CAST(row_number() OVER (PARTITION BY product_id, window_start ORDER BY fire DESC, impressions + clicks) AS INTEGER) AS nr,
       fire, CAST(impressions AS BIGINT) AS impressions, CAST(clicks AS BIGINT) AS clicks,
       CASE WHEN impressions = 0 THEN 0.0 ELSE clicks::DOUBLE / impressions END AS ctr, event_time_ms
FROM e"""
ORACLE_SQL |= {
    "stream_fire_log": _FIRE_SQL,
    "stream_dropped_rows": f"""{_STEPS_SQL}
SELECT CAST(step AS INTEGER) AS step, count(*) AS rows_in, count(*) FILTER (mark IS NULL OR window_start + {_6H_MS} > mark) AS counted,
       count(*) FILTER (window_start + {_6H_MS} <= mark) AS dropped
FROM p JOIN wm USING (step) GROUP BY 1""",
}
