"""What every micro-batch read, kept, and dropped as late.

A query's own progress list forgets all but its last batches, and Spark counts late rows after
its partial aggregation, so neither gives the number of dropped rows.  Here a listener writes
one small file for each micro-batch, named by its batch (a batch that runs again replaces its
file), with the number of valid rows that every source delivered (``observe`` metrics).  The
emission log gives the rows that each batch added to its windows.  The difference was dropped.
"""

from __future__ import annotations

import json
import threading
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql.streaming.listener import StreamingQueryListener

from clickrate.session import write_small_file

PROGRESS_SCHEMA = ("query_id string, batch_id long, input_rows long, state_rows long, dropped_groups long, watermark string, "
                   "observed map<string, struct<rows: long, newest_ms: long>>")


def batch_record(progress) -> dict:
    """What is kept of a ``StreamingQueryProgress``."""
    p = json.loads(progress.json)
    ops = p.get("stateOperators") or []
    observed = {k: {"rows": v["rows"], "newest_ms": v["newest_ms"]} for k, v in (p.get("observedMetrics") or {}).items() if v.get("rows") is not None}
    return {"query_id": p["id"], "batch_id": p["batchId"], "input_rows": p.get("numInputRows", 0),
            "state_rows": sum(o.get("numRowsTotal", 0) for o in ops), "dropped_groups": sum(o.get("numRowsDroppedByWatermark", 0) for o in ops),
            "watermark": (p.get("eventTime") or {}).get("watermark"), "observed": observed}


class ProgressListener(StreamingQueryListener):
    """Hands every micro-batch of the queries it is told of to ``handlers`` (functions of a
    ``batch_record``).  ``wait(query)`` returns when a stopped query's last batch was handed on."""

    def __init__(self, *handlers: Callable[[dict], None], query_name: str | None = None):
        self.handlers, self.query_name = handlers, query_name
        self._ended: dict[str, threading.Event] = {}

    def onQueryStarted(self, event) -> None:
        pass

    def onQueryProgress(self, event) -> None:
        if self.query_name is None or event.progress.name == self.query_name:
            for handler in self.handlers:
                handler(batch_record(event.progress))

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryTerminated(self, event) -> None:
        self._ended.setdefault(str(event.runId), threading.Event()).set()

    def wait(self, query, seconds: float = 60) -> bool:
        return self._ended.setdefault(str(query.runId), threading.Event()).wait(seconds)


class ProgressLog:
    """The table of micro-batches under ``path``."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path

    def record(self, batch: dict) -> None:
        write_small_file(self.spark, f"{self.path}/query={batch['query_id']}/batch-{batch['batch_id']:012d}.json", json.dumps(batch) + "\n")

    def read(self) -> DataFrame:
        return self.spark.read.schema(PROGRESS_SCHEMA).option("recursiveFileLookup", "true").json(self.path)


def drops_by_batch(batches: DataFrame, emitted: DataFrame) -> DataFrame:
    """batch_id, rows_in, counted, dropped for one checkpoint's batches in update mode.

    ``emitted`` is the emission log (product_id, window_start, impressions, clicks, batch_id): a
    window's rows carry running counts, so what a batch counted is the growth of its windows
    since they were emitted before.  A batch without progress row (the job died between commit
    and listener) shows a null ``rows_in``."""
    total = F.col("impressions") + F.col("clicks")
    before = F.lag(total, 1, 0).over(W.partitionBy("product_id", "window_start").orderBy("batch_id"))
    counted = emitted.select("batch_id", (total - before).alias("grown")).groupBy("batch_id").agg(F.sum("grown").alias("counted"))
    rows_in = batches.select("batch_id", F.aggregate(F.map_values("observed"), F.lit(0).cast("long"), lambda a, v: a + v["rows"]).alias("rows_in"))
    return (rows_in.join(counted, "batch_id", "full")
            .select("batch_id", "rows_in", F.coalesce("counted", F.lit(0)).cast("long").alias("counted"),
                    (F.col("rows_in") - F.coalesce("counted", F.lit(0))).cast("long").alias("dropped")))
