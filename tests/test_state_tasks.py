"""A checkpoint keeps its number of state partitions; the tasks over them are bounded all the same."""

import glob
import json
import os
import tempfile
from contextlib import nullcontext

import pytest
from pyspark.sql import functions as F

from clickrate.sinks.incremental import IncrementalTables
from clickrate.sources.files import stream_payload_files
from clickrate.streaming import replay
from clickrate.streaming.health import read_status, start_status_query, status_stream
from clickrate.streaming.job import WindowSettings, ctr_stream, start_ctr_query

B = 1704067200000
KEY, SHUFFLE = "spark.clickrate.statePartitions", "spark.sql.shuffle.partitions"
NOW = {"availableNow": True}


@pytest.fixture
def limit(spark):
    before = spark.conf.get(SHUFFLE)
    spark.conf.set(SHUFFLE, "12")
    yield lambda n: spark.conf.set(KEY, str(n))
    spark.conf.unset(KEY)
    spark.conf.set(SHUFFLE, before)


@pytest.fixture
def folders():
    root = tempfile.mkdtemp(prefix="state-tasks-")
    found = {s: os.path.join(root, s) for s in ("Impression", "Click")}
    for folder in found.values():
        os.makedirs(folder)
    return root, found


def _deliver(folders, step, times):
    for source, kind in (("Impression", "view"), ("Click", "click")):
        with open(os.path.join(folders[source], f"{step}.json"), "w") as f:
            f.writelines(json.dumps({"event_type": kind, "product_id": f"p{p}", "user_id": "u", "timestamp": B + t}) + "\n" for t, p in times)


def test_tasks_over_the_window_state(spark, limit, folders):
    root, sources = folders
    seen, stored = [], []

    class Watched(IncrementalTables):
        def apply_batch(self, batch, batch_id, run=None):
            seen.append(batch._jdf.queryExecution().toRdd().getNumPartitions())
            super().apply_batch(batch, batch_id, run)

    tables = Watched(spark, f"{root}/tables")
    for step, n in enumerate((12, 3)):
        limit(n)
        _deliver(sources, step, [(1000 * step, p) for p in range(40)])
        results = ctr_stream(*(stream_payload_files(spark, f, s) for s, f in sources.items()), WindowSettings())
        start_ctr_query(results, tables, f"{root}/chk", trigger=NOW, also=lambda df: stored.append(df._jdf.queryExecution().toRdd().getNumPartitions())).awaitTermination()
    assert len([d for d in os.listdir(f"{root}/chk/state/0") if d.isdigit()]) == 12
    assert seen[0] == 12 and seen[-1] == 3
    assert stored[0] == 12 and stored[-1] == 3
    rows = {(r["product_id"], r["impressions"], r["clicks"]) for r in tables.final_rows().collect()}
    assert rows == {(f"p{p}", 2, 2) for p in range(40)}


def test_tasks_over_the_status_state(spark, limit, folders):
    root, _ = folders
    schema = "source string, value binary, arrived_at timestamp"
    for step, n in enumerate((12, 2)):
        limit(n)
        (spark.range(40).selectExpr("concat('s', id) as source", "encode('{', 'UTF-8') as value", f"timestamp_millis({B + 1000 * step}) as arrived_at")
         .coalesce(1).write.mode("append").parquet(f"{root}/in"))
        counts = status_stream(spark.readStream.schema(schema).parquet(f"{root}/in"))
        start_status_query(counts, f"{root}/counts", f"{root}/chk", NOW).awaitTermination()
    files = [len(glob.glob(f"{root}/counts/batch_id={i}/*.parquet")) for i in (0, max(int(d.split("=")[1]) for d in os.listdir(f"{root}/counts") if "=" in d))]
    assert files[0] > 2 >= files[1]
    assert {(r["source"], r["valid"], r["invalid"]) for r in read_status(spark, f"{root}/counts").collect()} == {(f"s{i}", 0, 2) for i in range(40)}


def test_tasks_over_the_fire_log_state(spark, limit, folders, monkeypatch):
    root, _ = folders
    monkeypatch.setattr(replay, "state_partitions", lambda spark: nullcontext())  # the session's 12
    limit(2)
    spark.range(200).selectExpr(
        "id as event_id", f"cast(timestamp_millis({B} + id * 400) as timestamp_ntz) as ts", "id as user_id", "if(id % 2 = 0, 'view', 'click') as event_type",
        "1.0D as value", "concat('{\"k\": ', id div 2 % 20, '}') as props").write.parquet(f"{root}/events.parquet")
    log = replay.replay_fire_log(spark, root, 1, WindowSettings())
    chk = f"{os.path.dirname(log)}/chk/state/0".removeprefix("file:")
    assert len([d for d in os.listdir(chk) if d.isdigit()]) == 12
    rows = spark.read.parquet(log).withColumn("file", F.col("_metadata.file_path"))
    assert rows.select("file").distinct().count() <= 2
    # a window has 25 events
    assert rows.groupBy("window_start").agg(F.sum("impressions") + F.sum("clicks")).orderBy("window_start").collect()[0][1] == 25
