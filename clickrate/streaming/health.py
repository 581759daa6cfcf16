"""V9 as a stream: valid and invalid records a minute, from the same decode as the job.

The table holds every emitted count with its batch; a batch that runs again replaces its own
partition, and readers take each minute's newest version.  Rates and alerts come from that
table by the batch operators (``monitoring.invalid_rate``), so both agree.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from clickrate.operators.monitoring import MINUTE_MS
from clickrate.operators.parse import parse_payloads
from clickrate.session import in_state_tasks, state_partitions

STATUS_SCHEMA = "source string, point long, valid long, invalid long, batch_id long"


def status_stream(records: DataFrame, delay: str = "10 minutes") -> DataFrame:
    """source, point, valid, invalid of ``records`` (source, value, arrived_at); minutes older
    than the delay behind the newest arrival are closed."""
    parsed = parse_payloads(records).withWatermark("arrived_at", delay)
    counts = parsed.groupBy("source", F.window("arrived_at", f"{MINUTE_MS // 1000} seconds").alias("w")).agg(
        F.count_if("is_success").alias("valid"), F.count_if(~F.col("is_success")).alias("invalid"))
    return counts.select("source", F.unix_millis("w.end").alias("point"), "valid", "invalid")


def start_status_query(counts: DataFrame, path: str, checkpoint: str, trigger: dict | None = None):
    def write(batch: DataFrame, batch_id: int) -> None:
        (in_state_tasks(batch).withColumn("batch_id", F.lit(batch_id).cast("long")).write.mode("overwrite")
         .option("partitionOverwriteMode", "dynamic").partitionBy("batch_id").parquet(path))

    writer = counts.writeStream.outputMode("update").option("checkpointLocation", checkpoint).foreachBatch(write)
    with state_partitions(counts.sparkSession):
        return (writer.trigger(**trigger) if trigger else writer).start()


def read_status(spark: SparkSession, path: str) -> DataFrame:
    """The newest counts of every minute."""
    best = F.max_by(F.struct("valid", "invalid"), "batch_id").alias("b")
    return spark.read.schema(STATUS_SCHEMA).parquet(path).groupBy("source", "point").agg(best).select("source", "point", "b.*")
