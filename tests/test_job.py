"""The job entry point: files through all sinks, defaults, extension points, database options."""

import json

from pyspark.sql import functions as F

from clickrate.operators.window_agg import ctr_results, sink_projection
from clickrate.schema import SINK_COLUMNS
from clickrate.sinks.jdbc import jdbc_options
from clickrate.streaming import run

T0 = 1704067200000


def _folder(path, kind, times):
    path.mkdir()
    rows = [json.dumps({"event_type": kind, "product_id": "sku", "user_id": "v", "timestamp": T0 + t}) for t in times]
    (path / "part.json").write_text("\n".join([*rows, "{no json"]) + "\n")
    return {"path": str(path)}


def test_files_through_all_sinks(spark, tmp_path, monkeypatch):
    sent = []
    monkeypatch.setattr(run, "append_jdbc", lambda rows, options: sent.append((sink_projection(rows).collect(), options)))
    imp, clk = _folder(tmp_path / "i", "impression", [0, 1, 2, 3]), _folder(tmp_path / "c", "click", [4])
    doubled = [(2 * F.count_if(F.col("event_type") == "impression")).alias("impressions"), F.count_if(F.col("event_type") == "click").alias("clicks")]
    options = jdbc_options("jdbc:none://h/d", "no.Driver", writers=3)
    tables, queries = run.run_job(spark, imp, clk, str(tmp_path / "job"), trigger={"availableNow": True}, jdbc=options, agg_exprs=doubled,
                                  result_fn=lambda counts: ctr_results(counts).filter("product_id <> ''"))
    for q in queries:
        q.awaitTermination()
    want = {"product_id": "sku", "ctr": 0.125, "impressions": 8, "clicks": 1, "window_start": T0, "window_end": T0 + 10_000}
    assert [r.asDict() for r in tables.final_rows().select(*SINK_COLUMNS).collect()] == [want]
    rows = [r for batch, _ in sent for r in batch]
    assert [r.asDict() for r in rows][-1] == want and rows[0].__fields__ == list(SINK_COLUMNS) and sent[0][1] == options
    assert spark.read.parquet(str(tmp_path / "job" / "dlq")).count() == 2


def test_defaults(spark, tmp_path, monkeypatch):
    started, opened = [], []
    monkeypatch.setattr(run, "start_ctr_query", lambda results, tables, checkpoint, mode, trigger, *rest: started.append((mode, trigger)))
    monkeypatch.setattr(run, "start_dlq_query", lambda a, b, path, checkpoint, trigger: started.append(trigger))
    monkeypatch.setattr(run, "ctr_stream", lambda *a: None)
    monkeypatch.setattr(run, "stream_topic", lambda spark, source, **kw: opened.append((source, kw)))
    topic = {"bootstrap_servers": "h:1", "group_id": "g", "fail_on_data_loss": False}
    run.run_job(spark, {"topic": "shown", **topic}, {"topic": "clicked", **topic}, str(tmp_path))
    assert started == [("update", {"processingTime": "60 seconds"}), {"processingTime": "60 seconds"}]
    assert [(s, kw["topic"], kw["fail_on_data_loss"]) for s, kw in opened] == [("Impression", "shown", False), ("Click", "clicked", False)]


def test_database_options():
    assert jdbc_options("u", "d") == {"url": "u", "driver": "d", "dbtable": "ctr_results_raw", "batchsize": "1000", "isolationLevel": "NONE"}
