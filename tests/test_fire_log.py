"""W9 fire log on the FIXTURES.md §4 boundary sequence (steps 0-10)."""

import json
import os
import tempfile

from clickrate.sources.files import stream_payload_files
from clickrate.streaming.fire_log import fire_log_stream

B = 1704067200000
STEPS = [
    ([1000, 12000], [12000]), ([15000], [15000]), ([2000, 19999], [19999]), ([3000], [19999]),
    ([20000], [20000]), ([4000], [20000]), ([20001], [20001]), ([4500, 20001], [20001]),
    ([20001], [20001]), ([25001], [25001]), ([26000], [26000]),
]


def _payload(kind, t):
    return json.dumps({"event_type": kind, "product_id": "p", "timestamp": B + t})


def test_fire_sequence(spark):
    root = tempfile.mkdtemp(prefix="firelog-")
    imp_dir, clk_dir, out = (os.path.join(root, d) for d in ("imp", "clk", "out"))
    os.makedirs(imp_dir)
    os.makedirs(clk_dir)
    log = fire_log_stream(stream_payload_files(spark, imp_dir, "Impression"),
                          stream_payload_files(spark, clk_dir, "Click"))
    collected = []

    def sink(df, batch_id):
        for r in df.collect():  # a handful of test rows
            collected.append((batch_id, r["window_start"] - B, r["fire"], r["impressions"], r["clicks"]))

    for i, (imps, clks) in enumerate(STEPS):
        for folder, kind, times in ((imp_dir, "impression", imps), (clk_dir, "click", clks)):
            with open(os.path.join(folder, f"s{i:02d}.json"), "w") as fh:
                fh.write("\n".join(_payload(kind, t) for t in times) + "\n")
        q = (log.writeStream.outputMode("append").foreachBatch(sink)
             .option("checkpointLocation", os.path.join(root, "chk")).trigger(availableNow=True).start())
        q.awaitTermination()
    w0 = [(f, i, c) for _, ws, f, i, c in collected if ws == 0]
    w1 = [(f, i, c) for _, ws, f, i, c in collected if ws == 10000]
    assert w0 == [("on_time", 1, 0), ("late", 2, 0), ("late", 3, 0)]
    assert w1 == [("on_time", 3, 4)]
