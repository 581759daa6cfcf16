"""From raw documents to packed training sequences: five operators, each on all that the
stage before it has kept.

Stages take and give the columns doc_id, text, lang, source, n_chars; the last gives the
packed pieces.  Null columns, empty and repeated rows, empty tables and further columns are
handled as each operator's docstring says; further columns are dropped.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from clickrate.llm import decontam, langid, minhash, packing, secrets
from clickrate.llm.common import stored, table

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language is known with enough confidence.  Where no document has a known
    language there is nothing to learn from, and nothing to reject by: all stay."""
    model = langid.learn(docs)
    if model is None:
        return docs.select(COLUMNS)
    found = langid.identify(spark, docs, model, COLUMNS)
    return found.filter(~F.col("rejected")).select(COLUMNS)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of each group of near-duplicates (five words, 0.8): the one with the smallest
    doc_id, a null one only if all are null, then the smallest hash of its text; of rows that
    repeat both, the first by source, lang and n_chars.  Documents without words are no
    duplicates and stay."""
    docs = docs.select(COLUMNS)
    found = minhash.near_duplicates(spark, docs).withColumn("worded", F.col("n_shingles") > 0)
    kept = found.filter(~F.col("worded") | F.col("chosen")).select(F.col("doc_id").alias("kept_id"), F.col("text_hash").alias("kept_hash"), "worded").distinct()
    hashed = docs.withColumn("text_hash", F.xxhash64("text"))
    left = hashed.join(kept, hashed["doc_id"].eqNullSafe(kept["kept_id"]) & (hashed["text_hash"] == kept["kept_hash"]))
    copy = F.row_number().over(W.partitionBy("doc_id", "text_hash").orderBy("source", "lang", "n_chars"))
    return left.withColumn("copy", copy).filter((F.col("copy") == 1) | ~F.col("worded")).select(COLUMNS)


def benchmark_decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents of which less than a twentieth lies in benchmark passages."""
    found = decontam.contamination(spark, docs, table(spark, sf_dir, "benchmark"), carry=COLUMNS)
    return found.filter(~F.col("contaminated")).select(COLUMNS)


def secret_scans(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, with their secrets replaced by a mark."""
    return secrets.redacted(docs.select(COLUMNS))


def best_fit_packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents' pieces in sequences of 2048 tokens."""
    return packing.pack(spark, docs, added=True)


STAGES = [
    ("language_id", language_id),
    ("near_dedup", near_dedup),
    ("benchmark_decontamination", benchmark_decontamination),
    ("secret_scans", secret_scans),
    ("best_fit_packing", best_fit_packing),
]
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every stage in turn, each written as Parquet under spark.checkpoint.dir and read by the next."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = stored(spark, stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
