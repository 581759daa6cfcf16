"""Reading, stored intermediate tables and Arrow row mapping shared by the operators."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from clickrate.session import shared_dir

SLICE_ROWS = 256


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def stored(spark: SparkSession, df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` under spark.checkpoint.dir and read it back: cuts the lineage at a
    table that survives lost executors and is computed once."""
    path = shared_dir(spark, f"llm/{name}")
    df.write.option("compression", "zstd").parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def map_rows(df: DataFrame, make: Callable[[], Callable[[dict], dict]], adds: str, inputs: list[str],
             carry: list[str] = (), slice_rows: int = SLICE_ROWS) -> DataFrame:
    """Columns ``carry`` of ``df`` as they are, and the columns ``adds`` (DDL) that a
    function computes.  ``make()`` runs once per partition; its function gets lists of the
    ``inputs`` for at most ``slice_rows`` rows, so memory is bound by one slice.  Without
    ``carry`` it may give more or fewer rows than it got."""
    added = T.StructType.fromDDL(adds)
    schema = T.StructType([df.schema[c] for c in carry] + added.fields)
    arrow, new = to_arrow_schema(schema), {f.name for f in added}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fn = make()
        for batch in batches:
            for at in range(0, batch.num_rows, slice_rows):
                part = batch.slice(at, slice_rows)
                out = fn({c: part.column(c).to_pylist() for c in inputs})
                yield pa.RecordBatch.from_arrays(
                    [pa.array(out[f.name], type=f.type) if f.name in new else part.column(f.name).cast(f.type) for f in arrow], schema=arrow)

    return df.select(*dict.fromkeys([*inputs, *carry])).mapInArrow(run, schema)


def held_out(doc_id, modulus: int):
    """crc32 of doc_id as text, modulo ``modulus`` (null ids: null)."""
    return F.crc32(doc_id.cast("string").cast("binary")) % F.lit(modulus)


def bounded_sample(df: DataFrame, key, rows: int) -> DataFrame:
    """At most ``rows`` rows in the order of a hash of ``key``: the same rows for the
    same table.  The hash cut keeps the sort small; it never binds for small tables."""
    n = max(1, df.count())
    h = F.xxhash64(key, F.lit(17))
    cut = min(1.0, 1.5 * rows / n + 1e-6) if n > rows else 1.0
    return df.withColumn("_h", h).filter(F.pmod("_h", F.lit(1_000_000)) < int(cut * 1_000_000)).orderBy(F.pmod("_h", F.lit(1_000_000)), "_h").limit(rows).drop("_h")


class WordHash(dict):
    """word (bytes) -> 64-bit hash, remembered for up to ``most`` words."""

    def __init__(self, most: int = 400_000):
        super().__init__()
        self.most = most

    def __missing__(self, word: bytes) -> int:
        h = xxhash.xxh3_64_intdigest(word)
        if len(self) < self.most:
            self[word] = h
        return h

    def of(self, words: list[bytes]) -> np.ndarray:
        return np.fromiter(map(self.__getitem__, words), dtype=np.uint64, count=len(words))
