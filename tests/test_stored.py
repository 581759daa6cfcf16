"""Stored tables: what the queries over them read, and that their averages test something."""

import pytest
from pyspark.sql import functions as F

from clickrate.functions.timekeys import month_key
from clickrate.operators import queries as Q
from clickrate.plans import stored
from clickrate.schema import RAW_TABLE_SCHEMA
from clickrate.sinks.tables import export, to_raw_rows, write_raw_table
from clickrate.sources.files import read_payload_files
from clickrate.sources.result_table import newest_end_ms, read_raw_table
from tests.conftest import SF_SMALL


@pytest.mark.parametrize("name,column", [("stored_minute_rollup", "avg_ctr"), ("stored_avg_ctr_24h", "avg_ctr"),
                                         ("stored_product_history", "ctr"), ("stored_latest_top10", "latest_ctr")])
def test_ratios_are_not_all_zero(spark, name, column):
    # sf0.01 has 6-7 valid events in a window
    rows = stored.QUERIES[name](spark, "/root/testdata/sf0.01").collect()
    assert sum(r[column] > 0 for r in rows) >= 0.5 * len(rows) > 0


@pytest.mark.parametrize("name", ["stored_last_day", "stored_avg_ctr_24h", "stored_avg_ctr_24h_rollup"])
def test_time_bound_reads_one_pruned_table(spark, name):
    plan = stored.QUERIES[name](spark, SF_SMALL)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan") == 1
    assert "window_month" in plan.split("PartitionFilters: [")[1].split("]")[0]
    assert "GreaterThanOrEqual" in plan.split("PushedFilters: [")[1].split("]")[0]


def test_files_are_in_stored_order(spark):
    """Q6: (window_end, product_id) within each file."""
    rows = read_raw_table(spark, stored.store(spark, SF_SMALL).raw).select(
        F.input_file_name().alias("f"), "_metadata.row_index", "window_end", "product_id").collect()
    files = {}
    for r in sorted(rows, key=lambda r: r["row_index"]):
        files.setdefault(r["f"], []).append((r["window_end"], r["product_id"]))
    assert files and all(v == sorted(v) for v in files.values())


def test_insert_time_is_now_in_ms(spark):
    """P15."""
    r = read_raw_table(spark, stored.store(spark, SF_SMALL).raw).select(
        F.max(F.pmod(F.unix_micros("inserted_at"), F.lit(1000))).alias("below_ms"),
        F.max(F.abs(F.unix_seconds(F.current_timestamp()) - F.unix_seconds("inserted_at"))).alias("age")).first()
    assert r["below_ms"] == 0 and r["age"] < 3600


def test_sample_takes_rows_of_the_table(spark):
    """Q3."""
    rows = read_raw_table(spark, stored.store(spark, SF_SMALL).raw)
    got = Q.sample(rows, 100)
    assert got.count() == 100 and got.exceptAll(rows).count() == 0


@pytest.mark.parametrize("fmt", ["csv", "parquet"])
def test_export_round_trip(spark, tmp_path, fmt):
    """K7."""
    rows = read_raw_table(spark, stored.store(spark, SF_SMALL).raw).drop("inserted_at", "window_month")
    path = str(tmp_path / fmt)
    export(rows, path, fmt)
    back = (spark.read.option("header", True).schema(rows.schema).csv(path) if fmt == "csv" else spark.read.parquet(path))
    assert back.exceptAll(rows).count() == 0 and rows.exceptAll(back).count() == 0


def test_empty_table_has_no_newest_end(spark, tmp_path):
    path = str(tmp_path / "raw")
    spark.createDataFrame([], RAW_TABLE_SCHEMA).write.parquet(path)
    assert newest_end_ms(spark, path) is None


def test_append_keeps_earlier_rows(spark, tmp_path):
    """K1 / K3: two inserts, both months kept."""
    path = str(tmp_path / "raw")
    schema = "product_id string, impressions long, clicks long, ctr double, window_start long, window_end long"
    for start in (1_706_700_000_000, 1_706_800_000_000):
        write_raw_table(to_raw_rows(spark.createDataFrame([("a", 4, 1, 0.25, start, start + 10_000)], schema)), path)
    back = read_raw_table(spark, path)
    assert back.count() == 2 and {r[0] for r in back.select("window_month").collect()} == {202401, 202402}
    assert back.filter(month_key(F.col("window_end")) != F.col("window_month")).count() == 0


def test_payload_files_read_in_batch(spark, tmp_path):
    """S5, batch side."""
    (tmp_path / "a.json").write_text('{"event_type":"view"}\nbroken\n')
    rows = read_payload_files(spark, str(tmp_path), "Click").collect()
    assert sorted(tuple(r) for r in rows) == [("Click", "broken"), ("Click", '{"event_type":"view"}')]
