"""Edge cases, merges and the stated errors."""

import json
import math

import pytest
from pyspark.sql import functions as F

from clickrate.operators import monitoring as M
from clickrate.operators import series
from clickrate.operators.quality import validated, validity_summary, violation_breakdown
from clickrate.plans import monitoring as P
from clickrate.sources.events_adapter import arrival_records, load_events
from tests.conftest import SF_SMALL

NOW = 1_704_067_200_000
MINUTE = 60_000


# -- violations -----------------------------------------------------------------------------------

CASES = [
    ({"user_id": "u", "product_id": "p", "event_type": "view", "timestamp": NOW}, []),
    ({"user_id": "u", "product_id": "p", "event_type": "view", "timestamp": NOW + 60_000}, []),
    ({"user_id": "u", "product_id": "p", "event_type": "view", "timestamp": NOW + 60_001}, [f"timestamp is in the future: {NOW + 60_001} > {NOW}"]),
    ({"user_id": "u", "product_id": "p", "event_type": "click", "timestamp": NOW - 604_800_000}, []),
    ({"user_id": "u", "product_id": "p", "event_type": "click", "timestamp": NOW - 604_800_001}, ["timestamp is too old (> 7 days)"]),
    ({"user_id": " ", "product_id": "", "event_type": "CLICK"}, ["userId is required", "productId is required", "invalid eventType: CLICK"]),
    ({}, ["userId is required", "productId is required", "eventType is required", "invalid eventType: null"]),
    ({"user_id": 7, "product_id": 1.5, "event_type": "\t", "timestamp": "x"}, ["eventType is required", "invalid eventType: \t"]),
    ({"user_id": "u", "product_id": "p", "event_type": "view", "timestamp": 2 ** 63 - 1}, [f"timestamp is in the future: {2 ** 63 - 1} > {NOW}"]),
    ({"user_id": "u", "product_id": "p", "event_type": "view", "timestamp": -(2 ** 63)}, ["timestamp is too old (> 7 days)"]),
    ('{"user_id":', ["Malformed JSON"]), ("", ["Malformed JSON"]), (None, ["Malformed JSON"]), ('{"product_id":{}}', ["Malformed JSON"]),
]


def _records(spark):
    rows = [(i, "S", v if v is None or isinstance(v, str) else json.dumps(v)) for i, (v, _) in enumerate(CASES)]
    return spark.createDataFrame(rows, "i int, source string, value string").withColumn("value", F.encode("value", "UTF-8"))


def test_every_violation_is_listed(spark):
    got = {r["i"]: [v["message"] for v in r["violations"]] for r in validated(_records(spark), F.lit(NOW)).collect()}
    assert got == {i: want for i, (_, want) in enumerate(CASES)}


def test_counters_and_breakdown_agree(spark):
    rows = validated(_records(spark), F.lit(NOW))
    total = validity_summary(rows).first()
    by_rule = {r["rule"]: r["n"] for r in violation_breakdown(rows).collect()}
    assert (total["valid"], total["invalid"]) == (3, len(CASES) - 3)
    assert total["missing_fields"] == sum(by_rule[r] for r in ("user_id", "product_id", "event_type"))
    assert total["future_timestamps"] == by_rule["future_timestamp"] == 2 and by_rule["undecodable"] == 4 and by_rule["unknown_type"] == 3


def test_valid_records_are_the_same_with_every_event(spark):
    """Decoding invalid events too must not change which are valid, or the envelope's error."""
    from clickrate.operators.parse import parse_payloads
    a, b = (parse_payloads(_records(spark), every_event=e).select("i", "is_success", "error_message").orderBy("i").collect() for e in (False, True))
    assert a == b


# -- series ---------------------------------------------------------------------------------------

def brute_runs(points, hold, step=MINUTE):
    runs, now = [], []
    for p in sorted(points):
        if now and p - now[-1] != step:
            runs.append(now)
            now = []
        now.append(p)
    return sorted((r[0], r[-1], len(r), r[0] + hold) for r in [*runs, now] if r and r[-1] - r[0] >= hold)


@pytest.mark.parametrize("chunk", [MINUTE, 3 * MINUTE, 7 * MINUTE + 1, series.CHUNK_MS])
def test_runs_across_chunks(spark, chunk):
    points = [NOW + MINUTE * k for k in [*range(0, 25), *range(27, 30), 31, *range(40, 56), 60, 61]]
    both = [("a", p) for p in points] + [("b", p) for p in points[:12]] + [("b", points[30])]
    df = spark.createDataFrame(both, "k string, point long")
    for hold in (0, 2 * MINUTE, 15 * MINUTE):
        got = series.failing_runs(df, F.lit(True), hold, keys=("k",), chunk_ms=chunk).collect()
        for k in "ab":
            want = brute_runs([p for x, p in both if x == k], hold)
            assert sorted(tuple(r)[1:] for r in got if r["k"] == k) == want
    assert series.failing_runs(df, F.lit(False), 0).collect() == []


def test_range_frames_do_not_depend_on_chunks(spark):
    rows = [("hot", NOW + 97_000 * k, float(k % 7), 1) for k in range(400)] + [("cold", NOW, 1.0, 1), ("cold", NOW + 90_000_000, 2.0, 1)]
    df = spark.createDataFrame(rows, "k string, at long, v double, n long")
    frames = {"near": (-600_000, 0, ("v", "n")), "far": (-9_000_000, -3_600_000, ("v", "n"))}
    got = {chunk: sorted(map(tuple, series.range_frames(df, "k", "at", frames, chunk).collect())) for chunk in (500_000, 7_000_000, 10 ** 12)}
    assert got[500_000] == got[7_000_000] == got[10 ** 12]
    for k, at, _, _, *sums in got[500_000]:
        want = []
        for lo, hi, _ in frames.values():
            inside = [r for r in rows if r[0] == k and at + lo < r[1] <= at + hi]
            want += [sum(r[2] for r in inside), len(inside)] if inside else [None, None]
        assert sums == want


def test_no_window_runs_over_a_whole_series(spark):
    """Windows are partitioned: nothing sorts all points in one task."""
    counts = spark.createDataFrame([("a", NOW, 1, 2)], "source string, point long, valid long, invalid long")
    plan = M.invalid_rate_alerts(counts)._jdf.queryExecution().executedPlan().toString()
    assert "SinglePartition" not in plan


def test_windows_without_events_are_in_the_series(spark):
    counts = spark.createDataFrame([("a", NOW + MINUTE, 600, 0), ("a", NOW + 30 * MINUTE, 60_000, 0)], "source string, point long, valid long, invalid long")
    rates = {r["point"]: r for r in M.event_rate(spark, counts, NOW, NOW + 30 * MINUTE).collect()}
    assert sorted(rates) == [NOW + k * MINUTE for k in range(5, 31)]
    assert [rates[NOW + k * MINUTE]["events"] for k in (5, 6, 29, 30)] == [600, 0, 0, 60_000]
    assert not rates[NOW + 30 * MINUTE]["low"] and rates[NOW + 29 * MINUTE]["low"]
    run, = M.event_rate_alerts(M.event_rate(spark, counts, NOW, NOW + 30 * MINUTE)).collect()
    assert (run["started_at"], run["ended_at"], run["fired_at"]) == (NOW + 5 * MINUTE, NOW + 29 * MINUTE, NOW + 20 * MINUTE)


def test_queries_have_empty_windows_and_both_states(spark):
    rates = P.event_rate(spark, SF_SMALL)
    r = rates.agg(F.count_if(F.col("events") == 0).alias("none"), F.count_if(F.col("low")).alias("low"), F.count(F.lit(1)).alias("n")).first()
    assert 0 < r["none"] <= r["low"] < r["n"]
    assert P.invalid_rate_alerts(spark, "/root/testdata/sf0.01").count() > 0


# -- CTR anomaly -----------------------------------------------------------------------------------

def _ctr_rows(spark, rows):
    return spark.createDataFrame(rows, "product_id string, end_ms long, ctr double").withColumn("window_end", F.timestamp_millis("end_ms"))


def test_anomaly_bounds_and_baselines(spark):
    hour, day = M.HOUR_MS, M.DAY_MS
    rows = [("up", NOW, 0.4), ("up", NOW - hour, 9.0), ("up", NOW - day, 0.2), ("up", NOW - day + 1, 9.0), ("up", NOW - 2 * day, 9.0), ("up", NOW - 2 * day + 1, 0.2),
            ("same", NOW, 0.3), ("same", NOW - day - 5, 0.2), ("new", NOW, 1.0), ("gone", NOW - day, 0.5), ("future", NOW + 1, 1.0),
            ("from zero", NOW - 1, 0.1), ("from zero", NOW - day, 0.0), ("still zero", NOW, 0.0), ("still zero", NOW - day, 0.0)]
    got = {r["product_id"]: r for r in M.ctr_anomaly(_ctr_rows(spark, rows), NOW).collect()}
    assert set(got) == {"up", "same", "new", "gone", "from zero", "still zero"}
    assert got["up"]["change"] == pytest.approx(1.0) and got["up"]["anomalous"]
    assert got["same"]["change"] == pytest.approx(0.5) and got["new"]["change"] is None and not got["new"]["anomalous"]
    assert got["gone"]["recent_ctr"] is None and not got["gone"]["anomalous"]
    assert got["from zero"]["change"] is None and got["from zero"]["anomalous"] and not got["still zero"]["anomalous"]


def test_anomaly_series_agrees_with_the_point_query(spark):
    from clickrate.operators.rollups import minute_parts
    rows = [("p", NOW + k * 1_800_000, (k * k % 11) / 10) for k in range(150)] + [("q", NOW, 0.5)]
    df = _ctr_rows(spark, rows).withColumns({"impressions": F.lit(1), "clicks": F.lit(1)})
    got = {(r["product_id"], r["point"]): r for r in M.ctr_anomaly_series(minute_parts(df)).collect()}
    assert len(got) == len(rows)
    for at in (NOW, NOW + 60 * 1_800_000, NOW + 149 * 1_800_000):
        one = {r["product_id"]: r for r in M.ctr_anomaly(df, at).collect()}["p"]
        mine = got["p", at]
        for c in ("recent_ctr", "baseline_ctr", "change", "anomalous"):
            assert mine[c] == (pytest.approx(one[c]) if isinstance(one[c], float) else one[c])


# -- mergeable states ---------------------------------------------------------------------------------

def test_latency_is_within_the_stated_error(spark):
    from clickrate.operators.parse import parse_payloads
    rows = parse_payloads(arrival_records(load_events(spark, SF_SMALL))).filter("is_success").withColumn(
        "event_ms", F.col("event.timestamp") - F.pmod(F.xxhash64("event.event_id"), F.lit(5_000_000)))
    state = M.latency_parts(rows, F.col("arrived_at"), F.col("event_ms"))
    halves = [M.latency_parts(rows.filter(F.pmod(F.xxhash64("event.event_id", F.lit(3)), F.lit(3)) == k), F.col("arrived_at"), F.col("event_ms")) for k in range(3)]
    merged = M.merge_latency(halves[0].union(halves[1]).union(halves[2]))
    assert sorted(merged.collect()) == sorted(state.collect())
    got = M.latency_percentiles(merged, F.lit(0)).first()
    exact = sorted(r[0] for r in rows.select(F.greatest(F.unix_millis("arrived_at") - F.col("event_ms"), F.lit(0))).collect())
    assert got["n"] == len(exact)
    for q in M.PERCENTILES:
        true = exact[math.ceil(q * len(exact)) - 1]
        assert 0 <= true - got[f"p{round(q * 100)}"] <= true / 128


def test_latency_buckets(spark):
    values = [0, 1, 255, 256, 257, 511, 512, 65_535, 65_536, 10 ** 12, 2 ** 62]
    rows = spark.createDataFrame([(v,) for v in values], "ms long").select("ms", M.bucket_latency(M.latency_bucket(F.col("ms"))).alias("low")).collect()
    for r in rows:
        assert 0 <= r["ms"] - r["low"] <= r["ms"] / 128 and (r["ms"] >= 256 or r["ms"] == r["low"])
    assert spark.range(1).select(M.latency_bucket(F.lit(-5).cast("long"))).first()[0] == 0


def test_activity_sketches(spark):
    rows = spark.range(60_000).select(F.concat(F.lit("product"), F.col("id")).alias("product_id"), F.timestamp_millis(F.lit(NOW) + F.col("id") % 600 * 1000).alias("window_end"))
    exact = 60_000
    whole = M.activity_parts(rows)
    a, b = M.activity_parts(rows.filter("hash(product_id) % 2 = 0")), M.activity_parts(rows)  # windows counted again change nothing
    merged = M.merge_activity(a.union(b))
    assert merged.count() == whole.count() == 10
    for parts in (whole, merged):
        n = M.active_products(parts, F.lit(0)).first()["active_products"]
        assert abs(n - exact) / exact < 0.05  # three standard errors of 1.6 %
    few = rows.filter(F.col("window_end") < F.timestamp_millis(F.lit(NOW + 2000)))
    assert M.active_products(M.activity_parts(few), F.lit(0)).first()["active_products"] == few.count()


def test_empty_tables(spark):
    counts = spark.createDataFrame([], "source string, point long, valid long, invalid long")
    assert M.invalid_rate(counts).count() == 0 and M.invalid_rate_alerts(counts).count() == 0
    assert M.event_rate(spark, counts, 0, 0).count() == 0
    assert M.ctr_anomaly(_ctr_rows(spark, []), NOW).count() == 0
    assert M.latency_percentiles(spark.createDataFrame([], "window_minute timestamp, bucket long, n long"), F.col("window_minute")).count() == 0
