"""Counts, ratio and merge (FIXTURES.md §3) plus the split/merge property."""

from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from clickrate.operators.window_agg import count_exprs, merge_counts, with_ratio

B = 1704067200000


def _events(spark, types):
    rows = [(f"e{i}", t, "p", "u", B + i) for i, t in enumerate(types)]
    return spark.createDataFrame(rows, "event_id string, event_type string, product_id string, "
                                       "user_id string, timestamp long")


def _count(spark, types):
    df = _events(spark, types)
    return tuple(df.agg(*count_exprs()).first())


def test_counts(spark):
    assert _count(spark, []) == (0, 0)
    assert _count(spark, ["impression", "impression"]) == (2, 0)
    assert _count(spark, ["click"] * 3) == (0, 3)
    assert _count(spark, ["impression", "click", "view"]) == (2, 1)
    assert _count(spark, ["view", "click"]) == (1, 1)


def _ratio(spark, imps, clicks):
    df = spark.createDataFrame([(imps, clicks)], "impressions long, clicks long")
    return with_ratio(df).first()["ctr"]


def test_ratio(spark):
    assert _ratio(spark, 80, 6) == 0.075
    assert _ratio(spark, 0, 7) == 0.0
    assert _ratio(spark, 2, 4) == 2.0


def test_merge(spark):
    parts = spark.createDataFrame([("p", 0, 10, 37, 4), ("p", 0, 10, 61, 9)],
                                  "product_id string, window_start long, window_end long, "
                                  "impressions long, clicks long")
    r = merge_counts(parts).first()
    assert (r["impressions"], r["clicks"]) == (98, 13)


@settings(max_examples=5, deadline=None)
@given(st.lists(st.tuples(st.sampled_from(["view", "impression", "click", "other"]),
                          st.integers(0, 3)), min_size=1, max_size=40))
def test_any_split_merges_to_whole(spark, spec):
    rows = [(f"e{i}", t, "p", B + i, part) for i, (t, part) in enumerate(spec)]
    df = spark.createDataFrame(rows, "event_id string, event_type string, product_id string, "
                                     "timestamp long, part int")
    whole = tuple(df.agg(*count_exprs()).first())
    parts = df.groupBy("part").agg(*count_exprs()).withColumn("product_id", F.lit("p")) \
        .withColumn("window_start", F.lit(0)).withColumn("window_end", F.lit(1))
    merged = merge_counts(parts).first()
    assert (merged["impressions"], merged["clicks"]) == whole
