"""V13-V15, W6, W9 on streams: silent sources, expiring state, the table of micro-batches, topic records."""

import json
import os
import tempfile
import time

import pytest
from pyspark.sql import functions as F

from clickrate.operators.parse import dead_letters, parse_payloads
from clickrate.session import write_small_file
from clickrate.sinks.dlq import dlq_topic_writer, topic_options, topic_records
from clickrate.sinks.incremental import IncrementalTables
from clickrate.sources.files import stream_payload_files
from clickrate.streaming.idle import IdleSources, heartbeat_stream
from clickrate.streaming.job import WindowSettings, ctr_stream, start_ctr_query
from clickrate.streaming.progress import ProgressListener, ProgressLog, batch_record, drops_by_batch
from clickrate.streaming.retention import retained_counts

B = 1704067200000
SOURCES = ("Impression", "Click")
NOW = {"availableNow": True}


class Job:
    """Two file sources with one folder each; ``step`` delivers offsets from B and runs the query."""

    def __init__(self, spark, make, **start):
        self.spark, self.root = spark, tempfile.mkdtemp(prefix="stream-state-")
        self.folders = {s: os.path.join(self.root, s) for s in SOURCES}
        for f in self.folders.values():
            os.makedirs(f)
        raws = [stream_payload_files(spark, f, s) for s, f in self.folders.items()]
        self.stream, self.n = make(self.root, *raws), 0
        self.tables = IncrementalTables(spark, os.path.join(self.root, "tables"))

    def deliver(self, imps=(), clks=()):
        for source, kind, times in zip(SOURCES, ("impression", "click"), (imps, clks)):
            if times:
                with open(os.path.join(self.folders[source], f"s{self.n:02d}.json"), "w") as f:
                    f.write("".join(json.dumps({"event_type": kind, "product_id": "p", "timestamp": B + t}) + "\n" for t in times))
        self.n += 1

    def step(self, imps=(), clks=(), mode="update"):
        self.deliver(imps, clks)
        q = start_ctr_query(self.stream, self.tables, os.path.join(self.root, "chk"), mode, NOW)
        q.awaitTermination()
        return q

    def final(self):
        return sorted((r["window_start"] - B, r["impressions"], r["clicks"]) for r in self.tables.final_rows().collect())


# -- V15: a silent source -------------------------------------------------------------------------

def idle_job(spark):
    state = {}

    def make(root, imp, clk):
        beats = {s: os.path.join(root, "beats", s) for s in SOURCES}
        state["clock"] = [0.0]
        state["idle"] = IdleSources(spark, beats, 30, lambda: state["clock"][0])
        return ctr_stream(imp, clk, heartbeats={s: heartbeat_stream(spark, f) for s, f in beats.items()})

    return Job(spark, make), state


def test_windows_close_when_clicks_stop(spark):
    job, state = idle_job(spark)

    def step(at, imps=(), clks=()):
        state["clock"][0] = at
        q = job.step(imps, clks, "append")
        for p in q.recentProgress:
            state["idle"].record(batch_record(p))

    step(0, [1000, 2000], [1500])
    step(10, [25_000], [])       # clicks are silent for 10 s: the window stays open
    step(20, [26_000], [])
    assert job.final() == []
    step(35, [40_000], [])       # 35 s: a heartbeat at 40 000 is written ...
    step(36, [41_000], [])       # ... and read with this batch; its watermark closes [0, 10 s) and [20, 30 s)
    step(37, [41_500], [])
    assert job.final() == [(0, 2, 1), (20_000, 2, 0)]
    # clicks return: 3 000 is behind the watermark and vanishes, 41 000 counts in its open window
    step(38, [], [3000, 41_000])
    step(39, [90_000], [90_000])
    step(40, [90_001], [90_001])
    assert job.final() == [(0, 2, 1), (20_000, 2, 0), (40_000, 3, 1)]


def test_without_heartbeats_the_windows_wait(spark):
    job = Job(spark, lambda root, imp, clk: ctr_stream(imp, clk))
    for imps, clks in (([1000], [1500]), ([40_000], []), ([90_000], [])):
        job.step(imps, clks, "append")
    assert job.final() == []


def test_idle_rule():
    written = []

    class Recorder(IdleSources):
        def record(self, batch):
            before = dict(self.written)
            super().record(batch)
            written.extend((s, b) for s, b in self.written.items() if before.get(s) != b)

    clock = [0.0]
    import clickrate.streaming.idle as idle
    real, idle.write_small_file = idle.write_small_file, lambda *a: None
    try:
        r = Recorder(None, {"a": "a", "b": "b", "c": "c"}, 30, lambda: clock[0])

        def batch(at, **rows):
            clock[0] = at
            r.record({"observed": {s: {"rows": 1, "newest_ms": t} for s, t in rows.items()} | {"other": {"rows": 5, "newest_ms": 10 ** 15}}})

        batch(1, a=100, b=200, c=300)
        batch(29, a=400)
        assert written == []
        batch(31, a=500, b=210)         # c is silent for 30 s; the slowest active source is b, which is behind c's own newest
        assert written == []
        batch(32, b=600)
        assert written == [("c", 500)]
        batch(33, b=600)                # nothing new: no second heartbeat
        batch(70, c=700)                # a and b are silent now
        assert written == [("c", 500), ("a", 700), ("b", 700)]
        batch(200)                      # all are silent
        assert len(written) == 3
    finally:
        idle.write_small_file = real


# -- V14: state that expires by processing time ------------------------------------------------------

@pytest.fixture
def no_empty_batches(spark):
    spark.conf.set("spark.sql.streaming.noDataMicroBatches.enabled", "false")
    yield
    spark.conf.unset("spark.sql.streaming.noDataMicroBatches.enabled")


def test_state_expires(spark, no_empty_batches):
    job = Job(spark, lambda root, imp, clk: retained_counts(imp, clk, ttl_s=15))
    rows = []

    def run(imps, clks=()):
        job.deliver(imps, clks)
        q = (job.stream.writeStream.outputMode("update").option("checkpointLocation", os.path.join(job.root, "chk"))
             .foreachBatch(lambda df, n: rows.append(sorted((r["window_start"] - B, r["impressions"], r["clicks"], r["fresh"]) for r in df.collect())))
             .trigger(**NOW).start())
        q.awaitTermination()
        return sum(o["numRowsTotal"] for o in q.lastProgress["stateOperators"])

    held = [run([1000, 11_000, 21_000], [31_000]), run([2000])]
    assert held == [4, 4] and rows[0] == [(0, 1, 0, True), (10_000, 1, 0, True), (20_000, 1, 0, True), (30_000, 0, 1, True)]
    assert rows[1] == [(0, 2, 0, False)]          # before the expiry: the running count
    time.sleep(16)
    assert run([51_000]) == 1                      # the four expired, one new
    run([3000])
    assert rows[-1] == [(0, 1, 0, True)]           # counted anew, not from the expired 2


# -- W6: the table of micro-batches ---------------------------------------------------------------------

def test_drops_are_exact_after_progress_is_forgotten(spark):
    spark.conf.set("spark.sql.streaming.numRecentProgressUpdates", "2")
    try:
        job = Job(spark, lambda root, imp, clk: ctr_stream(imp, clk))
        log = ProgressLog(spark, os.path.join(job.root, "progress"))
        listener = ProgressListener(log.record)
        spark.streams.addListener(listener)
        late = {2: [500] * 7, 4: [100, 200, 35_000]}
        for i in range(5):
            q = job.step([10_000 * (i + 1)] + late.get(i, []), [10_000 * (i + 1)])
            assert listener.wait(q)
        spark.streams.removeListener(listener)
        assert len(q.recentProgress) <= 2
        got = drops_by_batch(log.read(), job.tables.emission_log()).filter("rows_in > 0").orderBy("batch_id").collect()
        assert [r["rows_in"] for r in got] == [2 + len(late.get(i, [])) for i in range(5)]
        # 7 rows of one group in step 2, 2 of 3 in step 4 (the window of 35 000 is open)
        assert [r["dropped"] for r in got] == [0, 0, 7, 0, 2]
        spark_counts = [r[0] for r in log.read().groupBy("query_id").agg(F.sum("dropped_groups")).select("sum(dropped_groups)").collect()]
        assert spark_counts[0] < 9  # Spark counts groups: the seven equal windows are one
    finally:
        spark.conf.unset("spark.sql.streaming.numRecentProgressUpdates")


def test_progress_rows_are_replaced_by_a_repeated_batch(spark, tmp_path):
    log = ProgressLog(spark, str(tmp_path / "p"))
    row = {"query_id": "q", "batch_id": 3, "input_rows": 5, "state_rows": 1, "dropped_groups": 0, "watermark": None, "observed": {"Click": {"rows": 4, "newest_ms": 9}}}
    log.record(row)
    log.record(row | {"input_rows": 6})
    log.record(row | {"batch_id": 4, "observed": {}})
    rows = log.read().orderBy("batch_id").collect()
    assert [(r["batch_id"], r["input_rows"]) for r in rows] == [(3, 6), (4, 5)] and rows[0]["observed"]["Click"]["rows"] == 4
    emitted = spark.createDataFrame([("p", 0, 3, 0, 3), ("p", 0, 4, 0, 5)], "product_id string, window_start long, impressions long, clicks long, batch_id long")
    got = {r["batch_id"]: (r["rows_in"], r["counted"], r["dropped"]) for r in drops_by_batch(log.read(), emitted).collect()}
    assert got == {3: (4, 3, 1), 4: (0, 0, 0), 5: (None, 1, None)}


def test_small_files_replace_each_other(spark, tmp_path):
    path = str(tmp_path / "a" / "x.json")
    for text in ("one\n", "two\n"):
        write_small_file(spark, path, text)
    assert open(path).read() == "two\n" and [f for f in os.listdir(tmp_path / "a") if not f.endswith(".crc")] == ["x.json"]


# -- V13: dead letters to a topic --------------------------------------------------------------------------

def test_topic_records(spark):
    raw = spark.createDataFrame([("Click", bytearray(b"\xff{")), ("Impression", None), ("Impression", bytearray(b'{"product_id":"p"}')),
                                 ("Click", bytearray(b'{"product_id":"p","event_type":"click","timestamp":1}'))], "source string, value binary")
    rows = topic_records(dead_letters(parse_payloads(raw))).collect()
    got = sorted((bytes(r["key"]), r["value"] and bytes(r["value"]), [(h["key"], bytes(h["value"])) for h in r["headers"]][0], [h["key"] for h in r["headers"]]) for r in rows if r["value"])
    assert got == [(b"Click", b"\xff{", ("error_message", b"Malformed JSON"), ["error_message", "processing_time"]),
                   (b"Impression", b'{"product_id":"p"}', ("error_message", b"Invalid event data"), ["error_message", "processing_time"])]
    assert len(rows) == 3
    assert {f.name: f.dataType.simpleString() for f in topic_records(dead_letters(parse_payloads(raw))).schema} == {
        "key": "binary", "value": "binary", "headers": "array<struct<key:string,value:binary>>"}


def test_topic_writer_options(spark, tmp_path):
    assert topic_options("h:1") == {"kafka.bootstrap.servers": "h:1", "topic": "events.dlq", "includeHeaders": "true", "kafka.acks": "all", "kafka.enable.idempotence": "true"}
    raw = stream_payload_files(spark, str(tmp_path), "Click")
    writer = dlq_topic_writer(dead_letters(parse_payloads(raw)), "h:1", str(tmp_path / "chk"), trigger={"processingTime": "60 seconds"})
    with pytest.raises(Exception, match="(?i)kafka"):  # the connector is not on this machine
        writer.start()
