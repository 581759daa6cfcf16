"""Streaming lateness (FIXTURES.md §4) and stream-versus-batch equality."""

import json
import os
import tempfile

import pytest

from clickrate.sinks.incremental import IncrementalTables
from clickrate.sources.files import stream_payload_files
from clickrate.streaming.job import ctr_stream, progress_dropped_rows, start_ctr_query

B = 1704067200000
SF_SMALL = "/root/testdata/sf0.001"

# Boundary sequence: (impression times, click times) per step, offsets from B.
STEPS = [
    ([1000, 12000], [12000]),
    ([15000], [15000]),
    ([2000, 19999], [19999]),
    ([3000], [19999]),
    ([20000], [20000]),
    ([4000], [20000]),
    ([20001], [20001]),
]
# Window [B, B+10 s) after each step: (impressions, clicks).
EXPECTED = [(1, 0), (1, 0), (2, 0), (3, 0), (3, 0), (3, 0), (3, 0)]


def _payload(kind, t):
    return json.dumps({"event_type": kind, "product_id": "p", "user_id": "u", "timestamp": B + t})


@pytest.fixture(scope="module")
def boundary_run(spark):
    root = tempfile.mkdtemp(prefix="lateness-")
    imp_dir, clk_dir = os.path.join(root, "imp"), os.path.join(root, "clk")
    os.makedirs(imp_dir)
    os.makedirs(clk_dir)
    tables = IncrementalTables(spark, os.path.join(root, "tables"))
    results = ctr_stream(stream_payload_files(spark, imp_dir, "Impression"),
                         stream_payload_files(spark, clk_dir, "Click"))
    seen, dropped = [], []
    for i, (imps, clks) in enumerate(STEPS):
        for folder, kind, times in ((imp_dir, "impression", imps), (clk_dir, "click", clks)):
            with open(os.path.join(folder, f"step{i:02d}.json"), "w") as fh:
                fh.write("\n".join(_payload(kind, t) for t in times) + "\n")
        q = start_ctr_query(results, tables, os.path.join(root, "chk"), "update", {"availableNow": True})
        q.awaitTermination()
        dropped.append(progress_dropped_rows(q))
        row = [r for r in tables.final_rows().collect() if r["window_start"] == B]
        seen.append((row[0]["impressions"], row[0]["clicks"]) if row else None)
    return seen, dropped, tables


def test_window_counts_follow_lateness_bound(boundary_run):
    seen, _, _ = boundary_run
    assert seen == EXPECTED


def test_too_late_row_is_dropped_and_counted(boundary_run):
    _, dropped, _ = boundary_run
    assert dropped[5] == 1
    assert sum(dropped[:5]) == 0


def test_second_window_final_row(boundary_run):
    _, _, tables = boundary_run
    rows = {r["window_start"]: (r["impressions"], r["clicks"]) for r in tables.final_rows().collect()}
    assert rows[B + 10000] == (3, 4)


def test_stream_equals_batch(spark):
    from clickrate.plans.batch import batch_ctr
    from clickrate.streaming.replay import replay_events

    r = replay_events(spark, SF_SMALL, steps=3, with_dlq=False)
    stream = {tuple(x) for x in r.tables.final_rows().select(
        "product_id", "impressions", "clicks", "ctr", "window_start", "window_end").collect()}
    batch = {tuple(x) for x in batch_ctr(spark, SF_SMALL).collect()}
    assert stream == batch and len(batch) > 0
