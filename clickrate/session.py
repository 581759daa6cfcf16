"""Session defaults and the shared working folder."""

from __future__ import annotations

import os
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

# Runtime SQL settings every job relies on.
#  * UTC: month keys and minute buckets are defined in UTC.
#  * allowMultiple=false: late rows are filtered with the current batch's
#    watermark, which gives the exact lateness bound of the windowed job.
#  * multipleWatermarkPolicy=min: a union of two sources waits for the slower.
SESSION_DEFAULTS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.streaming.statefulOperator.allowMultiple": "false",
    "spark.sql.streaming.multipleWatermarkPolicy": "min",
}

_WORK_KEY = "spark.clickrate.workDir"

# Each task over a window state sends the driver a counter for each of the state's partitions, so
# that a micro-batch sends their square.  The state is dealt over no more than this many, and no
# more tasks than this run over a state that has more.
STATE_PARTITIONS_KEY, STATE_PARTITIONS = "spark.clickrate.statePartitions", 64
_SHUFFLE_KEY = "spark.sql.shuffle.partitions"


def configure(spark: SparkSession) -> SparkSession:
    """Apply the runtime settings above to an existing session (idempotent)."""
    for key, value in SESSION_DEFAULTS.items():
        if spark.conf.get(key, None) != value:
            spark.conf.set(key, value)
    return spark


def _state_limit(spark: SparkSession) -> int:
    return int(spark.conf.get(STATE_PARTITIONS_KEY, str(STATE_PARTITIONS)))


def in_state_tasks(rows: DataFrame) -> DataFrame:
    """``rows`` of a stateful query, computed by at most ``spark.clickrate.statePartitions`` tasks.  A
    checkpoint keeps the number of partitions it began with, however high; with a bounded number of
    tasks what they send grows with that number, not with its square."""
    return rows.coalesce(_state_limit(rows.sparkSession))


@contextmanager
def state_partitions(spark: SparkSession) -> Iterator[None]:
    """Stateful queries started within get ``spark.clickrate.statePartitions`` partitions (64 unless
    it is set), or the session's number where that is lower.  A query takes its settings when it
    starts; one that has a checkpoint keeps the number it began with."""
    before = spark.conf.get(_SHUFFLE_KEY)
    spark.conf.set(_SHUFFLE_KEY, str(min(int(before), _state_limit(spark))))
    try:
        yield
    finally:
        spark.conf.set(_SHUFFLE_KEY, before)


def get_session(master: str | None = None, app_name: str = "clickrate",
                shuffle_partitions: int | None = None, **extra: str) -> SparkSession:
    """Build (or fetch) a session with the defaults; local runs get a scratch
    checkpoint folder, cluster runs must name a shared one themselves."""
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    builder = builder.config("spark.ui.enabled", "false")
    for key, value in SESSION_DEFAULTS.items():
        builder = builder.config(key, value)
    if shuffle_partitions:
        builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    for key, value in extra.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("WARN")
    return configure(spark)


def _checkpoint_base(spark: SparkSession) -> str:
    conf = spark.sparkContext.getConf()
    base = conf.get("spark.checkpoint.dir", None) or spark.conf.get(_WORK_KEY, None)
    if base:
        return base
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError(
            "spark.checkpoint.dir is not set: name a folder every executor can "
            "reach (HDFS / object store) before running jobs that write tables")
    # Local runs only (tests, laptops): a scratch folder stands in for the
    # shared one.
    base = tempfile.mkdtemp(prefix="clickrate-")
    spark.conf.set(_WORK_KEY, base)
    spark.sparkContext.setCheckpointDir(os.path.join(base, "rdd-checkpoints"))
    return base


def shared_dir(spark: SparkSession, name: str, unique: bool = True) -> str:
    """A folder under ``spark.checkpoint.dir`` for tables, sinks and stream
    checkpoints.  ``unique`` appends a fresh id so runs never collide."""
    base = _checkpoint_base(spark).rstrip("/")
    leaf = f"{name}-{uuid.uuid4().hex[:12]}" if unique else name
    return f"{base}/clickrate/{leaf}"


def ensure_dir(spark: SparkSession, path: str) -> str:
    """Create ``path`` through the Hadoop file system (works for any scheme)."""
    jvm = spark.sparkContext._jvm
    hpath = jvm.org.apache.hadoop.fs.Path(path)
    hpath.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).mkdirs(hpath)
    return path


def write_small_file(spark: SparkSession, path: str, text: str) -> None:
    """Write a file of a few lines through the Hadoop file system, in place of an earlier one.
    It is written beside its place under a hidden name and then renamed, so that no reader sees half of it."""
    jvm = spark.sparkContext._jvm
    target = jvm.org.apache.hadoop.fs.Path(path)
    hidden = jvm.org.apache.hadoop.fs.Path(target.getParent(), f".{target.getName()}-{uuid.uuid4().hex[:8]}")
    fs = target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    out = fs.create(hidden, True)
    try:
        out.write(bytearray(text, "utf-8"))
    finally:
        out.close()
    fs.delete(target, False)
    if not fs.rename(hidden, target):
        raise OSError(f"cannot rename {hidden} to {target}")
