"""Replayable sources over files of raw JSON lines (one payload per line).

Batch and streaming reads yield the same (source, value) shape as a topic
read, so the parse job is identical.  The stream side is a plain file source:
each new file is picked up once, progress is kept in the query checkpoint.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def read_payload_files(spark: SparkSession, path: str, source: str) -> DataFrame:
    return spark.read.text(path).select(F.lit(source).alias("source"), F.col("value"))


def stream_payload_files(spark: SparkSession, path: str, source: str,
                         max_files_per_trigger: int | None = None) -> DataFrame:
    reader = spark.readStream.format("text")
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", str(max_files_per_trigger))
    return reader.load(path).select(F.lit(source).alias("source"), F.col("value"))
