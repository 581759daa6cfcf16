"""Benchmark: the CTR pipeline and its read queries at one scale factor.

Prints one JSON line:
{"metric": ..., "value": total_sec, "unit": "sec", "queries": {...}, "sf": ...}

Timings are warm (one untimed warm-up of the pipeline first, so JIT and code
generation are not billed to the first query).  ``events_per_sec`` is the
batch pipeline's throughput: raw payloads → parse / DLQ split → union →
10 s windows → CTR rows.
"""

from __future__ import annotations

import json
import os
import re
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from pyspark.sql import functions as F  # noqa: E402

from clickrate.functions.timekeys import month_key  # noqa: E402
from clickrate.operators import queries as Q  # noqa: E402
from clickrate.operators import rollups as R  # noqa: E402
from clickrate.plans.batch import batch_ctr, events_to_parsed  # noqa: E402
from clickrate.session import get_session, shared_dir  # noqa: E402
from clickrate.sinks.tables import to_raw_rows, write_raw_table  # noqa: E402
from clickrate.sources.result_table import newest_end_ms, read_raw_table  # noqa: E402
from clickrate.streaming.replay import replay_events  # noqa: E402


def _sink(df):
    """Run a plan to the end without moving rows to the driver."""
    df.write.format("noop").mode("overwrite").save()


def _timed(fn, repeat: int = 3) -> float:
    best = None
    for _ in range(repeat):
        t = time.perf_counter()
        fn()
        dt = time.perf_counter() - t
        best = dt if best is None else min(best, dt)
    return best


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1").rstrip("/")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    m = re.search(r"sf([0-9.]+)", sf_dir)
    sf = float(m.group(1)) if m else None
    spark = get_session(f"local[{cpus}]", app_name="clickrate-bench", shuffle_partitions=cpus,
                        **{"spark.driver.memory": "8g"})
    n_events = spark.read.parquet(f"{sf_dir}/events.parquet").count()

    # Warm-up (untimed): code generation for the parse and aggregate stages.
    _sink(batch_ctr(spark, sf_dir))

    times: dict[str, float] = {}
    times["parse_dlq_split"] = _timed(lambda: _sink(
        events_to_parsed(spark, sf_dir).parsed.groupBy("source", "error_message").count()))
    times["ctr_10s_pipeline"] = _timed(lambda: _sink(batch_ctr(spark, sf_dir)))
    times["ctr_1h_pipeline"] = _timed(lambda: _sink(batch_ctr(spark, sf_dir, "1 hour")))

    # Stored tables: raw (month partitioned, range sorted), minute parts, latest.
    root = shared_dir(spark, "bench")
    raw_path, parts_path, latest_path = f"{root}/ctr_results_raw", f"{root}/minute_parts", f"{root}/latest"
    t = time.perf_counter()
    write_raw_table(to_raw_rows(batch_ctr(spark, sf_dir)), raw_path, mode="overwrite")
    times["write_raw_table"] = time.perf_counter() - t
    raw = read_raw_table(spark, raw_path)
    t = time.perf_counter()
    (R.minute_parts(raw).withColumn("window_month", month_key(F.col("window_minute")))
     .write.mode("overwrite").partitionBy("window_month").parquet(parts_path))
    R.latest_per_product(raw).sortWithinPartitions("product_id").write.mode("overwrite").parquet(latest_path)
    times["build_rollups"] = time.perf_counter() - t

    as_of = newest_end_ms(spark, raw_path)
    latest = spark.read.parquet(latest_path)
    parts = spark.read.parquet(parts_path)
    raw_24h = read_raw_table(spark, raw_path, as_of - 86_400_000, as_of)
    raw_1h = read_raw_table(spark, raw_path, as_of - 3_600_000, as_of)

    times["lookup_latest_view"] = _timed(lambda: Q.point_lookup(latest, "product7").collect(), 5)
    times["product_history_raw"] = _timed(lambda: _sink(Q.product_history(raw, "product7")), 5)
    times["last_hour_raw"] = _timed(lambda: _sink(Q.last_hour(raw_1h, as_of)), 5)
    times["avg_ctr_24h_raw"] = _timed(lambda: Q.avg_ctr_since(raw_24h, 86_400, as_of).collect(), 5)
    times["avg_ctr_24h_rollup"] = _timed(lambda: Q.average_ctr_from_parts(parts, as_of - 86_400_000).collect(), 5)
    times["latest_top10"] = _timed(lambda: Q.top_recent(latest, 10).collect(), 5)
    times["minute_series_10m"] = _timed(lambda: Q.minute_series(
        R.finish_minute(parts), 10, as_of).collect(), 5)
    times["result_count"] = _timed(lambda: Q.row_count(raw).collect(), 5)

    # One run each, in two steps, not part of the total: file streams → tables, and the same with dead letters.
    streams = {"stream_2_steps": _timed(lambda: replay_events(spark, sf_dir, 2, with_dlq=False), 1),
               "stream_2_steps_and_dlq": _timed(lambda: replay_events(spark, sf_dir, 2), 1)}
    # Building the plan alone, part of every pipeline run above.
    plan = _timed(lambda: batch_ctr(spark, sf_dir)._jdf.queryExecution().executedPlan())

    total = sum(times.values())
    out = {
        "metric": "ctr_pipeline_and_queries_total",
        "value": round(total, 4),
        "unit": "sec",
        "queries": {k: round(v, 4) for k, v in times.items()},
        "streams": {k: round(v, 4) for k, v in streams.items()},
        "plan_ctr_10s": round(plan, 4),
        "sf": sf,
        "events": n_events,
        "events_per_sec": round(n_events / times["ctr_10s_pipeline"], 1),
        "cpus": cpus,
    }
    print(json.dumps(out))
    spark.stop()


if __name__ == "__main__":
    main()
