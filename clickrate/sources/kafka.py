"""Topic sources.

Value bytes only (the key is ignored), consumer group set, newest offsets when
the query has no checkpoint (a checkpoint always wins).  Needs the
spark-sql-kafka package on the classpath; it is not installed in the test
image; tests/test_data_loss.py checks the options, nothing here has run against a server.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def kafka_reader(spark: SparkSession, bootstrap_servers: str, topic: str, group_id: str,
                 starting_offsets: str = "latest", max_offsets_per_trigger: int | None = None,
                 fail_on_data_loss: bool = True):
    """``fail_on_data_loss=False`` lets the query go on past offsets that the topic no longer
    holds; those records are lost silently, so it is never the default."""
    reader = (spark.readStream.format("kafka")
              .option("kafka.bootstrap.servers", bootstrap_servers)
              .option("subscribe", topic)
              .option("kafka.group.id", group_id)
              .option("startingOffsets", starting_offsets)
              .option("failOnDataLoss", str(fail_on_data_loss).lower()))
    if max_offsets_per_trigger:
        reader = reader.option("maxOffsetsPerTrigger", str(max_offsets_per_trigger))
    return reader


def stream_topic(spark: SparkSession, bootstrap_servers: str, topic: str, group_id: str,
                 source: str, **kw) -> DataFrame:
    return (kafka_reader(spark, bootstrap_servers, topic, group_id, **kw).load()
            .select(F.lit(source).alias("source"), F.col("value")))
