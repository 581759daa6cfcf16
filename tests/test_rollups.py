"""Rollup and latest cases (FIXTURES.md §5)."""

from pyspark.sql import functions as F

from clickrate.operators import rollups as R

M0 = 1704067200000  # 2024-01-01 00:00:00


def _rows(spark, spec, product="p"):
    rows = [(product, M0 + (end_s - 10) * 1000, M0 + end_s * 1000, i, c, 0.0 if i == 0 else c / i)
            for end_s, i, c in spec]
    df = spark.createDataFrame(rows, "product_id string, window_start long, window_end long, "
                                     "impressions long, clicks long, ctr double")
    return R.as_timestamps(df)


def _minutes(df):
    return {(r["window_minute"].minute, round(r["avg_ctr"], 9), r["total_impressions"], r["total_clicks"])
            for r in df.collect()}


def test_unweighted_average(spark):
    out = _minutes(R.minute_rollup(_rows(spark, [(10, 100, 5), (20, 10, 5)])))
    assert out == {(0, 0.275, 110, 10)}


def test_window_ending_on_minute_counts_in_next_minute(spark):
    out = _minutes(R.minute_rollup(_rows(spark, [(50, 1, 0), (60, 1, 1)])))
    assert out == {(0, 0.0, 1, 0), (1, 1.0, 1, 1)}


def test_refire_double_counts_in_log_but_not_in_final(spark):
    log = _rows(spark, [(10, 2, 1), (10, 2, 2)])
    assert _minutes(R.minute_rollup(log)) == {(0, 0.75, 4, 3)}
    final = log.groupBy("product_id", "window_start").agg(
        F.max_by(F.struct("impressions", "clicks", "ctr", "window_end"), F.col("clicks")).alias("b")
    ).select("product_id", "window_start", "b.*")
    assert _minutes(R.minute_rollup(final)) == {(0, 1.0, 2, 2)}


def test_parts_merge_to_whole(spark):
    rows = _rows(spark, [(10, 100, 5), (20, 10, 5), (30, 7, 1), (70, 3, 3)])
    whole = _minutes(R.minute_rollup(rows))
    split = rows.withColumn("block", (F.unix_millis("window_end") / 10000).cast("long") % 2)
    merged = R.finish_minute(R.minute_parts(split, extra_keys=("block",)).drop("block"))
    assert _minutes(merged) == whole


def test_latest_forms_agree_and_pick_highest_window(spark):
    rows = _rows(spark, [(10, 100, 5), (20, 10, 5)]).unionByName(_rows(spark, [(50, 1, 0), (60, 1, 1)], "q"))
    a = {tuple(r) for r in R.latest_per_product(rows).collect()}
    b = {tuple(r) for r in R.latest_per_product_argmax(rows).collect()}
    assert a == b
    assert {(r[0], r[2], r[3]) for r in a} == {("p", 10, 5), ("q", 1, 1)}


def test_latest_tie_goes_to_later_version_then_larger_total(spark):
    rows = _rows(spark, [(10, 2, 1), (10, 2, 2)]).withColumn("v", F.lit(1))
    r = R.latest_per_product(rows, ("v",)).first()
    assert (r["latest_impressions"], r["latest_clicks"]) == (2, 2)
