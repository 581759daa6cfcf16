"""K1 over JDBC: appends of the six sink columns in insert order, 1000 rows a statement batch.

Needs the database's driver jar on the classpath; none is installed in the test image, so the
options and the columns are tested and nothing here has run against a server.
"""

from __future__ import annotations

from pyspark.sql import DataFrame

from clickrate.operators.window_agg import sink_projection

BATCH_SIZE = 1000


def jdbc_options(url: str, driver: str, table: str = "ctr_results_raw", batch_size: int = BATCH_SIZE,
                 writers: int | None = None) -> dict[str, str]:
    """``writers`` bounds the connections that are open at once (default: one for each partition)."""
    options = {"url": url, "driver": driver, "dbtable": table, "batchsize": str(batch_size), "isolationLevel": "NONE"}
    return options | ({"numPartitions": str(writers)} if writers else {})


def append_jdbc(rows: DataFrame, options: dict[str, str]) -> None:
    """Bounds stay epoch ms.  A batch that is replayed after a failure appends its rows again."""
    sink_projection(rows).write.format("jdbc").options(**options).mode("append").save()
