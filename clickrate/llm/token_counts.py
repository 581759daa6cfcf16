"""Token counts of documents in flat token files, found by a separator scan.

A flat file is a run of fixed-width little-endian ids (2 or 4 bytes) in which an
end-of-document id closes each document; nothing says where documents begin.  Files are
read as blocks of any size.  Each block is searched for the separator at once with numpy;
what it reports is the count of ids before its first separator, the counts between its
separators, and the count after its last.  A prefix scan over each file's blocks (running
sums in window functions) then gives the ids that earlier blocks have left open, which the
first separator of a later block closes, and each document's place in its file.

Defined results: a separator at the very start, or two in a row: a document of 0 ids.  Ids
after the last separator of a file are a document without an end (``closed`` false).  Null
or empty blocks count as no ids.  Blocks whose bytes are no multiple of the width raise an
error.  Null texts give a document of 0 ids; repeated rows and null doc_ids stay rows of
their own.  Other columns are ignored, whatever their names.
"""

from __future__ import annotations

import numpy as np
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql import Window as W

from clickrate.llm.common import map_rows, stored, table
from clickrate.llm.tokens import END, VOCABULARY, word_ids

BLOCK_IDS = 65_536


def flat_files(spark: SparkSession, path: str, width: int = 2, block_ids: int = BLOCK_IDS) -> DataFrame:
    """file, block, ids: the files under ``path`` cut into blocks."""
    size = width * block_ids
    read = spark.read.format("binaryFile").load(path).select(F.col("path").alias("file"), "content", "length")
    return read.select("file", "content", F.explode(F.sequence(F.lit(0).cast("long"), F.expr(f"(length - 1) div {size}"))).alias("block")) \
        .select("file", "block", F.expr(f"substring(content, cast(block * {size} + 1 as int), {size})").alias("ids"))


def separator_scan(blocks: DataFrame, separator: int = END, width: int = 2) -> DataFrame:
    """file, ordinal, n_tokens, closed of every document of every file (columns file, block, ids)."""

    def make():
        def fn(cols):
            out = {"head": [], "inner": [], "tail": []}
            for ids in cols["ids"]:
                x = np.frombuffer(ids or b"", f"<u{width}")
                at = np.flatnonzero(x == separator)
                out["head"].append(int(at[0]) if len(at) else None)
                out["inner"].append(np.diff(at) - 1)
                out["tail"].append(len(x) - (int(at[-1]) + 1 if len(at) else 0))
            return out

        return fn

    found = map_rows(blocks, make, "head long, inner array<long>, tail long", ["ids"], ["file", "block"])
    upto = W.partitionBy("file").orderBy("block").rowsBetween(W.unboundedPreceding, -1)
    ids = F.coalesce(F.sum("tail").over(upto), F.lit(0))
    # tails add up until a block with a separator starts anew: the sum before it is what to take off
    restart = F.coalesce(F.last(F.when(F.col("head").isNotNull(), F.col("before")), ignorenulls=True).over(upto), F.lit(0))
    n_docs = F.when(F.col("head").isNotNull(), F.size("inner") + 1).otherwise(0)
    scan = (found.withColumn("before", ids).withColumn("open", F.col("before") - restart)
            .withColumn("first", F.coalesce(F.sum(n_docs).over(upto), F.lit(0))))
    scan = scan.withColumn("last", F.row_number().over(W.partitionBy("file").orderBy(F.desc("block"))) == 1)
    closed = F.when(F.col("head").isNotNull(), F.concat(F.array(F.col("open") + F.col("head")), "inner")).otherwise(F.array().cast("array<long>"))
    rest = F.when(F.col("head").isNotNull(), F.col("tail")).otherwise(F.col("open") + F.col("tail"))
    docs = F.transform(closed, lambda n: F.struct(n.alias("n"), F.lit(True).alias("closed")))
    left = F.when(F.col("last") & (rest > 0), F.array(F.struct(rest.alias("n"), F.lit(False).alias("closed")))).otherwise(F.array().cast("array<struct<n:bigint,closed:boolean>>"))
    return (scan.select("file", "first", F.posexplode(F.concat(docs, left)).alias("k", "doc"))
            .select("file", (F.col("first") + F.col("k")).alias("ordinal"), F.col("doc.n").alias("n_tokens"), F.col("doc.closed").alias("closed")))


def flat_blocks(docs: DataFrame, vocabulary: str = VOCABULARY, block_ids: int = BLOCK_IDS) -> DataFrame:
    """Flat files of 16-bit ids, one for each task, in blocks that take no notice of where
    documents end (rows with ids), and which documents were written in which order (rows
    with doc_ids, beginning at ordinal ``block``)."""
    size = 2 * block_ids

    def run(batches):
        import pyarrow as pa

        words, file, block, ordinal, rest = word_ids(vocabulary), TaskContext.get().partitionId(), 0, 0, b""
        schema = pa.schema([("file", pa.int64()), ("block", pa.int64()), ("ids", pa.binary()), ("doc_ids", pa.list_(pa.int64()))])
        row = lambda at, ids, docs: pa.RecordBatch.from_arrays([pa.array([x], f.type) for x, f in zip((file, at, ids, docs), schema)], schema=schema)
        for batch in batches:
            for at in range(0, batch.num_rows, 256):
                part = batch.slice(at, 256)
                for text in part.column("text").to_pylist():
                    ids = np.frombuffer(words.ids(text), "<u4")
                    rest += ids.astype("<u2").tobytes() + END.to_bytes(2, "little")
                    whole = len(rest) // size
                    for k in range(whole):
                        yield row(block, rest[k * size : (k + 1) * size], None)
                        block += 1
                    rest = rest[whole * size :]
                yield row(ordinal, None, part.column("doc_id").to_pylist())
                ordinal += part.num_rows
        if rest:
            yield row(block, rest, None)

    return docs.select("doc_id", "text").mapInArrow(run, "file long, block long, ids binary, doc_ids array<long>")


def op4_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """doc_id, n_tokens of all ``documents``: written as flat files, counted by the scan."""
    files = stored(spark, flat_blocks(table(spark, sf_dir, "documents")), "flat-tokens")
    counted = separator_scan(files.filter("ids is not null").select("file", "block", "ids"))
    order = (files.filter("doc_ids is not null").select("file", "block", F.posexplode("doc_ids").alias("k", "doc_id"))
             .select("file", (F.col("block") + F.col("k")).alias("ordinal"), "doc_id"))
    return order.join(counted, ["file", "ordinal"]).select("doc_id", F.col("n_tokens").cast("long").alias("n_tokens"))
