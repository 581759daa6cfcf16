"""Registered queries of the monitoring operators (V1-V10, V12) and their oracles.

Rates and latencies read records with an arrival time; CTR figures read the stored tables.
Points in time are epoch ms, averages and ratios are rounded to 9 digits.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from clickrate.operators import monitoring as M
from clickrate.operators.parse import parse_payloads
from clickrate.operators.quality import validated, validity_summary, violation_breakdown
from clickrate.plans import stored
from clickrate.session import configure
from clickrate.sources.events_adapter import arrival_records, gappy_records, load_events
from clickrate.sources.result_table import read_raw_table

ROUND = 9
#: Low enough for these tables, which hold an event or two in five minutes; the rule's own limit is 100.
MIN_RATE = 0.01


def _rounded(df: DataFrame) -> DataFrame:
    return df.select(*[F.round(c, ROUND).alias(c) if t == "double" else F.unix_millis(c).alias(c) if t == "timestamp" else F.col(c) for c, t in df.dtypes])


# -- violation lists -----------------------------------------------------------------------------

def _validated(spark, sf) -> DataFrame:
    """The point "now" lies a day before the newest event, so events are future, old and current."""
    configure(spark)
    records = gappy_records(load_events(spark, sf))
    now = load_events(spark, sf).agg(F.max(F.unix_millis(F.col("ts").cast("timestamp")))).first()[0] or 0
    return validated(records, F.lit(now - M.DAY_MS))


def event_violations(spark, sf):
    """V1-V6: every record's whole list, in rule order."""
    rows = _validated(spark, sf)
    return rows.select("event_id", "source", F.concat_ws("; ", "violations.message").alias("violations"), F.size("violations").alias("n"))


def validity_counters(spark, sf):
    """V7: valid, invalid, future and missing-field counts."""
    return validity_summary(_validated(spark, sf))


def violations_by_rule(spark, sf):
    """V7: records by broken rule."""
    return violation_breakdown(_validated(spark, sf))


# -- rates and latency ----------------------------------------------------------------------------

def _arrived(spark, sf) -> DataFrame:
    configure(spark)
    return parse_payloads(arrival_records(load_events(spark, sf)))


def _counts(spark, sf) -> DataFrame:
    return M.status_counts(_arrived(spark, sf), F.col("arrived_at"))


def invalid_rate(spark, sf):
    return _rounded(M.invalid_rate(_counts(spark, sf)))


def invalid_rate_alerts(spark, sf):
    return M.invalid_rate_alerts(_counts(spark, sf))


def _rates(spark, sf) -> DataFrame:
    records = arrival_records(load_events(spark, sf))
    lo, hi = records.agg(F.min(F.unix_millis("arrived_at")), F.max(F.unix_millis("arrived_at"))).first()
    return M.event_rate(spark, _counts(spark, sf), lo or 0, hi or 0, MIN_RATE)


def event_rate(spark, sf):
    """V10, empty windows included."""
    return _rounded(_rates(spark, sf))


def event_rate_alerts(spark, sf):
    return M.event_rate_alerts(_rates(spark, sf))


def latency_percentiles(spark, sf):
    """Hourly p50, p95, p99 of arrival after event time, merged from the stored minutes."""
    parts = spark.read.parquet(stored.store(spark, sf).latency)
    return _rounded(M.latency_percentiles(parts, F.date_trunc("hour", "window_minute"), "hour"))


# -- CTR ----------------------------------------------------------------------------------------

def ctr_anomaly(spark, sf):
    """V8 as of the newest stored window."""
    s = stored.store(spark, sf)
    rows = read_raw_table(spark, s.raw, start_ms=s.newest - M.BASELINE_OFFSET_MS - M.BASELINE_MS)
    return _rounded(M.ctr_anomaly(rows, s.newest))


def ctr_anomaly_series(spark, sf):
    """V8 at every stored minute."""
    return _rounded(M.ctr_anomaly_series(spark.read.parquet(stored.store(spark, sf).minute)))


def active_products(spark, sf):
    """Products with results on each day, merged from the stored minute sketches."""
    parts = spark.read.parquet(stored.store(spark, sf).activity)
    return _rounded(M.active_products(parts, F.date_trunc("day", "window_minute"), "day"))


def ctr_distribution(spark, sf):
    """Stored windows of each day by CTR."""
    rows = read_raw_table(spark, stored.store(spark, sf).raw)
    return _rounded(M.ctr_distribution(rows, F.date_trunc("day", "window_end"), "day"))


QUERIES = {f.__name__: f for f in (
    event_violations, validity_counters, violations_by_rule, invalid_rate, invalid_rate_alerts, event_rate, event_rate_alerts,
    latency_percentiles, ctr_anomaly, ctr_anomaly_series, active_products, ctr_distribution)}


# -- oracles ---------------------------------------------------------------------------------------

_VIOLATIONS = """WITH e AS (
  SELECT event_id, event_id % 12 AS shape, epoch_us(ts) // 1000 AS ms, CASE WHEN event_type = 'click' THEN 'Click' ELSE 'Impression' END AS source,
         event_type AS kind, CAST(user_id AS VARCHAR) AS u, 'product' || json_extract_string(props, '$.k') AS p,
         (SELECT max(epoch_us(ts) // 1000) FROM events) - 86400000 AS now
  FROM events
),
f AS (
  SELECT event_id, source, shape, now, CASE WHEN shape = 7 THEN NULL ELSE ms END AS t,
         CASE WHEN shape IN (0, 6) THEN NULL WHEN shape = 1 THEN '' ELSE u END AS u,
         CASE WHEN shape IN (2, 6) THEN NULL WHEN shape = 3 THEN '' ELSE p END AS p,
         CASE shape WHEN 4 THEN NULL WHEN 5 THEN ' ' WHEN 6 THEN 'Click' ELSE kind END AS k
  FROM e
),
v AS (
  SELECT event_id, source, rule, message, nr FROM (
    SELECT event_id, source, shape, 1 AS nr, 'user_id' AS rule, 'userId is required' AS message, coalesce(trim(u), '') = '' AS broken FROM f
    UNION ALL SELECT event_id, source, shape, 2, 'product_id', 'productId is required', coalesce(p, '') = '' FROM f
    UNION ALL SELECT event_id, source, shape, 3, 'event_type', 'eventType is required', coalesce(trim(k), '') = '' FROM f
    UNION ALL SELECT event_id, source, shape, 4, 'future_timestamp', 'timestamp is in the future: ' || t || ' > ' || now, t > now + 60000 FROM f
    UNION ALL SELECT event_id, source, shape, 5, 'old_timestamp', 'timestamp is too old (> 7 days)', t < now - 604800000 FROM f
    UNION ALL SELECT event_id, source, shape, 6, 'unknown_type', 'invalid eventType: ' || coalesce(k, 'null'), coalesce(k, '') NOT IN ('click', 'impression', 'view') FROM f
  ) r WHERE broken AND shape <> 8
  UNION ALL SELECT event_id, source, 'undecodable', 'Malformed JSON', 0 FROM f WHERE shape = 8
)"""

_ARRIVED = """WITH a AS (
  SELECT CASE WHEN event_type = 'click' THEN 'Click' ELSE 'Impression' END AS source, epoch_us(ts) // 1000 AS ms,
         epoch_us(ts) // 1000 + coalesce(CAST(floor(abs(value) * 1000 + 0.5) AS BIGINT), 0) AS arrived,
         event_type IN ('view', 'impression', 'click') AS ok
  FROM events
),
b AS (
  SELECT source, (arrived // 60000 + 1) * 60000 AS point, count(*) FILTER (ok) AS valid, count(*) FILTER (NOT ok) AS invalid
  FROM a GROUP BY 1, 2
)"""
_INVALID = f"""{_ARRIVED},
r AS (
  SELECT source, point + k * 60000 AS point, CAST(sum(valid) AS BIGINT) AS valid, CAST(sum(invalid) AS BIGINT) AS invalid
  FROM b, range(5) s(k) GROUP BY 1, 2
),
i AS (SELECT *, invalid / (valid + invalid) AS invalid_rate, invalid / (valid + invalid) > 0.1 AS failing FROM r)"""
_RATE = f"""{_ARRIVED},
lim AS (SELECT min(arrived) + 300000 AS lo, max(arrived) AS hi FROM a),
spine AS (SELECT unnest(range(((lo + 59999) // 60000) * 60000, hi + 1, 60000)) AS point FROM lim),
i AS (
  SELECT spine.point, CAST(coalesce(sum(valid), 0) AS BIGINT) AS events, coalesce(sum(valid), 0) / 300.0::DOUBLE AS rate,
         coalesce(sum(valid), 0) / 300.0::DOUBLE < {MIN_RATE}::DOUBLE AS low
  FROM spine LEFT JOIN b ON b.point > spine.point - 300000 AND b.point <= spine.point GROUP BY 1
)"""


def _runs(points: str, failing: str, hold: int, keys: str) -> str:
    by = f"PARTITION BY {keys}" if keys else ""
    key = f"{keys}, " if keys else ""
    return f"""{points},
g AS (SELECT {key}point, point - 60000 * row_number() OVER ({by} ORDER BY point) AS island FROM i WHERE {failing}),
h AS (SELECT {key}min(point) AS started_at, max(point) AS ended_at FROM g GROUP BY {key}island)
SELECT *, (ended_at - started_at) // 60000 + 1 AS points, started_at + {hold} AS fired_at FROM h WHERE ended_at - started_at >= {hold}"""


_LATENCY = f"""{_ARRIVED},
l AS (SELECT arrived // 3600000 * 3600000 AS hour, greatest(arrived - ms, 0) AS ms FROM a WHERE ok),
s AS (SELECT *, greatest(length(bin(ms)) - 8, 0) AS shift, row_number() OVER (PARTITION BY hour ORDER BY ms) AS rank, count(*) OVER (PARTITION BY hour) AS total FROM l)
SELECT hour, max(total) AS n,
       min((ms >> shift) << shift) FILTER (rank >= ceil(total * 0.5::DOUBLE)) AS p50,
       min((ms >> shift) << shift) FILTER (rank >= ceil(total * 0.95::DOUBLE)) AS p95,
       min((ms >> shift) << shift) FILTER (rank >= ceil(total * 0.99::DOUBLE)) AS p99
FROM s GROUP BY hour"""

_JUDGED = """round(CASE WHEN baseline_ctr > 0 THEN (recent_ctr - baseline_ctr) / baseline_ctr END, 9) AS change,
       coalesce(CASE WHEN baseline_ctr > 0 THEN (recent_ctr - baseline_ctr) / baseline_ctr > 0.5 WHEN baseline_ctr = 0 THEN recent_ctr > 0 END, FALSE) AS anomalous"""


def oracles(over_store) -> dict[str, str]:
    """``over_store`` puts the stored CTR rows before a query."""
    return {
        "event_violations": f"""{_VIOLATIONS}
SELECT f.event_id, f.source, coalesce(string_agg(message, '; ' ORDER BY nr), '') AS violations, CAST(count(message) AS INTEGER) AS n
FROM f LEFT JOIN v USING (event_id) GROUP BY 1, 2""",
        "validity_counters": f"""{_VIOLATIONS},
n AS (SELECT f.event_id, f.source, count(message) AS n, count(*) FILTER (rule = 'future_timestamp') AS fut, count(*) FILTER (nr IN (1, 2, 3)) AS mis
      FROM f LEFT JOIN v USING (event_id) GROUP BY 1, 2)
SELECT source, count(*) FILTER (n = 0) AS valid, count(*) FILTER (n > 0) AS invalid, CAST(sum(fut) AS BIGINT) AS future_timestamps,
       CAST(sum(mis) AS BIGINT) AS missing_fields FROM n GROUP BY source""",
        "violations_by_rule": f"{_VIOLATIONS}\nSELECT source, rule, count(*) AS n FROM v GROUP BY 1, 2",
        "invalid_rate": f"{_INVALID}\nSELECT source, point, valid, invalid, round(invalid_rate, 9) AS invalid_rate, failing FROM i",
        "invalid_rate_alerts": _runs(_INVALID, "failing", M.INVALID_HOLD_MS, "source"),
        "event_rate": f"{_RATE}\nSELECT point, events, round(rate, 9) AS rate, low FROM i",
        "event_rate_alerts": _runs(_RATE, "low", M.LOW_HOLD_MS, ""),
        "latency_percentiles": _LATENCY,
        "ctr_anomaly": over_store(f""", n AS (SELECT max(window_end) AS now FROM ctr),
a AS (SELECT product_id, avg(ctr) FILTER (window_end > now - 3600000) AS recent_ctr,
             avg(ctr) FILTER (window_end <= now - 86400000) AS baseline_ctr
      FROM ctr, n WHERE window_end > now - 3600000 OR (window_end > now - 172800000 AND window_end <= now - 86400000) GROUP BY 1)
SELECT product_id, round(recent_ctr, 9) AS recent_ctr, round(baseline_ctr, 9) AS baseline_ctr, {_JUDGED} FROM a"""),
        "ctr_anomaly_series": over_store(f""", a AS (
  SELECT product_id, window_end AS point,
         avg(ctr) OVER (PARTITION BY product_id ORDER BY window_end RANGE BETWEEN 3599999 PRECEDING AND CURRENT ROW) AS recent_ctr,
         avg(ctr) OVER (PARTITION BY product_id ORDER BY window_end RANGE BETWEEN 172799999 PRECEDING AND 86400000 PRECEDING) AS baseline_ctr
  FROM ctr)
SELECT product_id, point, round(recent_ctr, 9) AS recent_ctr, round(baseline_ctr, 9) AS baseline_ctr, {_JUDGED} FROM a"""),
        "active_products": over_store("SELECT window_end // 86400000 * 86400000 AS day, count(DISTINCT product_id) AS active_products FROM ctr GROUP BY 1"),
        "ctr_distribution": over_store("""SELECT window_end // 86400000 * 86400000 AS day, CAST(least(floor(ctr * 20), 20) AS INTEGER) AS bucket,
       count(*) AS windows FROM ctr GROUP BY 1, 2"""),
    }
