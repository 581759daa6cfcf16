"""Dead-letter sinks.

Bad records of both sources go to one Parquet table (source, raw bytes,
error, trace, log line, processing time).  As a streaming file sink it is
exactly-once through the sink's own commit log.

``start_dlq_topic`` sends them to a topic instead: the payload's bytes as they came are the
value, the source is the key (one source's dead letters stay in order in one partition), and
what is known of the error are headers.  A topic sink is at-least-once: a batch that runs
again is sent again.  It needs the connector package; its records and options are tested,
nothing has run against a server.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def write_dlq(dlq: DataFrame, path: str, mode: str = "append") -> None:
    dlq.write.mode(mode).parquet(path)


def start_dlq_stream(dlq: DataFrame, path: str, checkpoint: str, trigger: dict | None = None,
                     query_name: str | None = None):
    writer = (dlq.writeStream.format("parquet").outputMode("append")
              .option("path", path).option("checkpointLocation", checkpoint))
    if query_name:
        writer = writer.queryName(query_name)
    if trigger:
        writer = writer.trigger(**trigger)
    return writer.start()


# The default topic and the header names.
DLQ_TOPIC = "events.dlq"
HEADERS = ("error_message", "stack_trace", "processing_time")


def topic_records(dlq: DataFrame) -> DataFrame:
    """key, value, headers: the columns a topic writer takes.  A null payload (a tombstone) stays
    null; headers that are null are left out."""
    def header(name):
        text = F.date_format(name, "yyyy-MM-dd'T'HH:mm:ss.SSS'Z'") if dict(dlq.dtypes)[name] == "timestamp" else F.col(name)
        return F.when(text.isNotNull(), F.struct(F.lit(name).alias("key"), F.encode(text, "UTF-8").alias("value")))

    return dlq.select(F.encode("source", "UTF-8").alias("key"), F.col("raw").alias("value"), F.array_compact(F.array(*map(header, HEADERS))).alias("headers"))


def topic_options(bootstrap_servers: str, topic: str = DLQ_TOPIC) -> dict[str, str]:
    return {"kafka.bootstrap.servers": bootstrap_servers, "topic": topic, "includeHeaders": "true",
            "kafka.acks": "all", "kafka.enable.idempotence": "true"}


def dlq_topic_writer(dlq: DataFrame, bootstrap_servers: str, checkpoint: str, topic: str = DLQ_TOPIC,
                     trigger: dict | None = None, query_name: str = "dlq-topic"):
    """The writer of the dead letters, with a checkpoint of its own; ``start()`` runs it."""
    writer = (topic_records(dlq).writeStream.format("kafka").outputMode("append").queryName(query_name)
              .options(**topic_options(bootstrap_servers, topic)).option("checkpointLocation", checkpoint))
    return writer.trigger(**trigger) if trigger else writer
