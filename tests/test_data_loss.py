"""Cases in which rows were once lost, and the settings that guard against them."""

import datetime
import os
import shutil

import pandas as pd
import pytest
from pyspark.sql import functions as F

from clickrate.plans.batch import batch_ctr
from clickrate.operators import rollups as R
from clickrate.operators.monitoring import active_products
from clickrate.sinks.incremental import ACTIVITY, FINAL, LATEST, MINUTE_PARTS, IncrementalTables
from clickrate.sinks.tables import compact_months, to_raw_rows, write_raw_table
from clickrate.sources.kafka import kafka_reader
from clickrate.sources.result_table import read_raw_table
from clickrate.streaming.fire_log import _fire_fn
from clickrate.streaming.job import WindowSettings, start_ctr_query
from tests.conftest import SF_SMALL

ROW_NAMES = ("product_id", "impressions", "clicks", "ctr", "window_start", "window_end")
ROW = "product_id string, impressions long, clicks long, ctr double, window_start long, window_end long"


def test_fresh_checkpoint_keeps_earlier_rows(spark, tmp_path):
    tables = IncrementalTables(spark, str(tmp_path))
    row = lambda p, i, c, w: spark.createDataFrame([(p, i, c, c / i, w, w + 10_000)], ROW)
    tables.apply_batch(row("a", 8, 2, 0), 0, run="first")
    tables.apply_batch(row("b", 5, 1, 0), 0, run="second")
    tables = IncrementalTables(spark, str(tmp_path))  # the runs are known from the table
    tables.apply_batch(row("a", 10, 4, 0), 1, run="second")
    views = lambda: [sorted(map(tuple, v.collect())) for v in (tables.final_rows(), tables.minute_view(), tables.latest_view())]
    before = views()
    assert [(r[0], r[1], r[2]) for r in before[0]] == [("a", 10, 4), ("b", 5, 1)]
    assert len(before[1]) == len(before[2]) == 2
    tables.apply_batch(row("a", 10, 4, 0), 1, run="second")  # a replayed batch changes nothing
    assert views() == before


def test_fifty_batches_read_a_constant_number_of_folders(spark, tmp_path):
    tables, read = IncrementalTables(spark, str(tmp_path)), []
    seen = tables._files

    def files(name, root, folders):
        read.append(sum(any(x.endswith(".parquet") for x in names) for f in folders for _, _, names in os.walk(f)))
        return seen(name, root, folders)

    tables._files, per_batch, step = files, [], 21_600_000
    spark.conf.set("spark.sql.shuffle.partitions", "1")
    try:
        for n in range(50):  # batch n emits window n first, and window n - 1 again with more impressions
            rows = [("a", 4, 2, 0.5, step * n, step * n + 10_000), ("a", 8, 2, 0.25, step * (n - 1), step * (n - 1) + 10_000)]
            read.clear()
            tables.apply_batch(spark.createDataFrame(rows[: 1 + (n > 0)], ROW).coalesce(1), n, run="r")
            per_batch.append(sum(read))
        assert len({tuple(per_batch[k : k + 4]) for k in range(9, 49, 4)}) == 1, per_batch
        views = lambda: [sorted(map(tuple, v.collect())) for v in (tables.final_rows(), tables.minute_view(), tables.latest_view(), tables.emission_log().select(*ROW_NAMES, "batch_id"))]
        before = views()
        assert len(before[0]) == 50 and sum(r[1] for r in before[0]) == 49 * 8 + 4 and len(before[3]) == 99
        assert before[1] == sorted(map(tuple, R.minute_rollup(R.as_timestamps(tables.final_rows())).collect()))
        days = [datetime.date(1970, 1, k) for k in range(1, 10)]
        for _ in range(2):  # rows in both places count once, and archiving again changes nothing
            tables.archive(days)
            assert views() == before
        for name in (FINAL, MINUTE_PARTS, LATEST, ACTIVITY):  # as an operator may do for days that are over
            for d in days:
                shutil.rmtree(f"{tables.path(name)}/window_month=197001/window_day={d}", ignore_errors=True)
        assert views() == before
        tables.apply_batch(spark.createDataFrame([("a", 9, 3, 1 / 3, 0, 10_000), ("b", 8, 2, 0.25, 0, 10_000)], ROW), 0, run="next")  # a later run goes back to an archived day
        after = views()
        assert [r for r in after[0] if r[0] == "a" and r[4]] == [r for r in before[0] if r[4]] and len(after[0]) == 51
        assert [(r[1], r[2]) for r in after[0] if r[0] == "a" and r[4] == 0] == [(9, 3)] and len(after[3]) == 101
        tables.archive(days[:1])
        assert views() == after
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", "4")


def test_activity_counts_windows_that_are_emitted_again_once(spark, tmp_path):
    tables = IncrementalTables(spark, str(tmp_path))
    row = lambda p, i: (p, i, 0, 0.0, 0, 10_000)
    for n, rows in enumerate(([row("a", 1), row("b", 1)], [row("a", 2)], [row("c", 1)])):
        tables.apply_batch(spark.createDataFrame(rows, ROW), n, run="r")
    assert active_products(tables.activity(), F.col("window_minute")).collect()[0]["active_products"] == 3


class State:
    def __init__(self, value, watermark):
        self.value, self.watermark, self.hasTimedOut = value, watermark, False

    exists = property(lambda s: s.value is not None)
    get = property(lambda s: s.value)

    def getCurrentWatermarkMs(self):
        return self.watermark

    def remove(self):
        self.value = None

    def update(self, value):
        self.value = value

    def setTimeoutTimestamp(self, _):
        pass


def test_on_time_row_comes_before_closing():
    fn, _ = _fire_fn(WindowSettings())
    late = pd.DataFrame({"event_type": ["view"], "timestamp": [5000]})
    state = State((1, 1, False), 13_000)  # the watermark is past both points of window [0, 10 s)
    out = pd.concat(list(fn(("p", 10_000), iter([late]), state)))
    assert out[["impressions", "clicks", "fire"]].values.tolist() == [[1, 1, "on_time"]] and not state.exists


def test_topic_reader_options(monkeypatch):
    class Reader:
        def __init__(self):
            self.options = {}

        def format(self, name):
            return self

        def option(self, k, v):
            self.options[k] = v
            return self

    class Session:
        readStream = property(lambda s: Reader())

    assert kafka_reader(Session(), "h:1", "t", "g").options["failOnDataLoss"] == "true"
    got = kafka_reader(Session(), "h:1", "t", "g", fail_on_data_loss=False, max_offsets_per_trigger=5).options
    assert got["failOnDataLoss"] == "false" and got["subscribe"] == "t" and got["kafka.group.id"] == "g" and got["maxOffsetsPerTrigger"] == "5"


@pytest.fixture(scope="module")
def stored_table(spark, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("raw"))
    write_raw_table(to_raw_rows(batch_ctr(spark, SF_SMALL, "1 hour")), path, "overwrite")
    return path


def test_one_sided_ranges_prune_months(spark, stored_table):
    for bound in ({"start_ms": 1_700_000_000_000}, {"end_ms": 1_700_000_000_000}):
        plan = read_raw_table(spark, stored_table, **bound)._jdf.queryExecution().executedPlan().toString()
        assert "window_month" in plan.split("PartitionFilters: [")[1].split("]")[0]


def test_compaction_leaves_the_source(spark, stored_table, tmp_path):
    src = read_raw_table(spark, stored_table)
    months = [r[0] for r in src.select("window_month").distinct().collect()]
    compact_months(spark, stored_table, str(tmp_path / "c"), months, files_per_month=2)
    got = read_raw_table(spark, str(tmp_path / "c"))
    assert got.count() == src.count() and got.select("product_id", "window_end", "clicks").exceptAll(src.select("product_id", "window_end", "clicks")).count() == 0
    files = got.select("window_month", F.input_file_name().alias("f")).distinct().groupBy("window_month").count().collect()
    assert all(r["count"] <= 2 for r in files)


def test_one_scan_of_the_events(spark):
    plan = batch_ctr(spark, SF_SMALL)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan") == 1 and plan.count("Exchange hashpartitioning") == 1


def test_lateness_setting_is_checked(spark, tmp_path):
    setting = "spark.sql.streaming.statefulOperator.allowMultiple"
    stream = spark.readStream.format("rate").load()
    spark.conf.set(setting, "true")
    try:
        with pytest.raises(ValueError, match="allowMultiple"):
            start_ctr_query(stream, IncrementalTables(spark, str(tmp_path)), str(tmp_path / "c"))
    finally:
        spark.conf.set(setting, "false")
