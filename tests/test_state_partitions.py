"""What a micro-batch sends to the driver: counters of the state's partitions, squared."""

import json
import os
import tempfile

import pytest

from clickrate.sinks.incremental import IncrementalTables
from clickrate.sources.files import stream_payload_files
from clickrate.streaming.job import WindowSettings, ctr_stream, start_ctr_query

B = 1704067200000
KEY = "spark.sql.shuffle.partitions"


class Watched(IncrementalTables):
    """Keeps the lineage of all that is written."""

    def __init__(self, spark, root):
        super().__init__(spark, root)
        self.lineage = {}

    def _write(self, name, rows, archived=False):
        self.lineage[name] = rows._jdf.queryExecution().toRdd().toDebugString()
        super()._write(name, rows, archived)


def _lines(folder, name, kind, times):
    with open(os.path.join(folder, name), "w") as f:
        f.writelines(json.dumps({"event_type": kind, "product_id": p, "user_id": "u", "timestamp": B + t}) + "\n" for t, p in times)


@pytest.fixture
def job(spark):
    root = tempfile.mkdtemp(prefix="state-partitions-")
    folders = {s: os.path.join(root, s) for s in ("Impression", "Click")}
    for folder in folders.values():
        os.makedirs(folder)
    tables = Watched(spark, f"{root}/tables")
    before = spark.conf.get(KEY)

    def step(i, times):
        for source, kind in (("Impression", "view"), ("Click", "click")):
            _lines(folders[source], f"{i}.json", kind, times)
        results = ctr_stream(*(stream_payload_files(spark, f, s) for s, f in folders.items()), WindowSettings())
        start_ctr_query(results, tables, f"{root}/chk", trigger={"availableNow": True}).awaitTermination()
        return len([d for d in os.listdir(f"{root}/chk/state/0") if d.isdigit()])

    yield tables, step
    spark.conf.unset("spark.clickrate.statePartitions")
    spark.conf.set(KEY, before)


def test_state_has_its_own_number_of_partitions(spark, job):
    _, step = job
    spark.conf.set(KEY, "100")
    assert step(0, [(1000, "a")]) == 64
    assert spark.conf.get(KEY) == "100"


def test_number_can_be_set_and_a_checkpoint_keeps_it(spark, job):
    tables, step = job
    spark.conf.set("spark.clickrate.statePartitions", "3")
    assert step(0, [(1000, "a"), (2000, "b")]) == 3
    spark.conf.set("spark.clickrate.statePartitions", "2")
    assert step(1, [(3000, "a")]) == 3
    rows = {(r["product_id"], r["impressions"], r["clicks"]) for r in tables.final_rows().collect()}
    assert rows == {("a", 2, 2), ("b", 1, 1)}


def test_a_lower_number_of_the_session_stays(spark, job):
    _, step = job
    spark.conf.set(KEY, "2")
    assert step(0, [(1000, "a")]) == 2


def test_tables_are_written_without_the_window_state(job):
    tables, step = job
    step(0, [(1000, "a"), (61_000, "a"), (86_400_000, "b")])
    assert set(tables.lineage) == {"final", "minute_parts", "latest", "activity"}
    assert not [name for name, text in tables.lineage.items() if "StateStoreRDD" in text]
    assert sorted(r["product_id"] for r in tables.final_rows().collect()) == ["a", "a", "b"]


def test_a_batch_that_runs_again_replaces_its_rows(spark):
    tables = IncrementalTables(spark, tempfile.mkdtemp(prefix="again-"))
    columns = "product_id string, impressions long, clicks long, ctr double, window_start long, window_end long"
    first = spark.createDataFrame([("a", 1, 1, 1.0, B, B + 10_000), ("b", 2, 0, 0.0, B, B + 10_000)], columns)
    second = spark.createDataFrame([("a", 3, 1, 1 / 3, B, B + 10_000)], columns)
    for batch_id, batch in ((0, first), (1, second), (1, second)):
        tables.apply_batch(batch, batch_id, "run")
    assert sorted((r["product_id"], r["impressions"], r["batch_id"]) for r in tables.emission_log().collect()) == [("a", 1, 0), ("a", 3, 1), ("b", 2, 0)]
    minute = {r["product_id"]: r["total_impressions"] for r in tables.minute_view().collect()}
    assert minute == {"a": 3, "b": 2}
    tables.apply_batch(first.limit(0), 2, "run")
    assert tables.final_rows().count() == 2
