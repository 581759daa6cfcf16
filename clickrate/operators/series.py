"""Series over regular points in time: a spine, sliding sums, runs of failing points, RANGE frames.

All of them work on rows that were aggregated into ``step`` buckets first, so what is sorted,
copied or joined here grows with the length of time, not with the events.  Points are epoch ms.
A point t stands for the bucket [t - step, t) and is read at its end, so a sliding value at t
covers [t - width, t).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

MINUTE_MS = 60_000
CHUNK_MS = 86_400_000


def bucket_end(ms: Column, step_ms: int = MINUTE_MS) -> Column:
    """The point whose bucket holds ``ms`` when buckets are [t - step, t)."""
    return ms - F.pmod(ms, F.lit(step_ms)) + F.lit(step_ms)


def time_spine(spark: SparkSession, first_ms: int, last_ms: int, step_ms: int = MINUTE_MS) -> DataFrame:
    """``point``: every multiple of the step from the first at or after ``first_ms`` up to
    ``last_ms``, whether or not anything happened there.  Generated inside the tasks."""
    lo = -(-first_ms // step_ms)
    return spark.range(lo, max(lo, last_ms // step_ms + 1)).select((F.col("id") * step_ms).alias("point"))


def sliding_sums(buckets: DataFrame, values: Sequence[str], width_ms: int, step_ms: int = MINUTE_MS, keys: Sequence[str] = ()) -> DataFrame:
    """Sums of ``values`` over [point - width, point), for every point some bucket reaches.

    Each bucket is handed to the width / step points it counts for, and those are summed by
    (keys, point): an aggregate with map-side partial sums in place of one sorted window over
    the whole series."""
    reach = F.explode(F.sequence(F.lit(0), F.lit(width_ms // step_ms - 1)))
    return (buckets.select(*keys, "point", *values, reach.alias("_k"))
            .withColumn("point", F.col("point") + F.col("_k") * F.lit(step_ms))
            .groupBy(*keys, "point").agg(*[F.sum(v).alias(v) for v in values]))


def failing_runs(points: DataFrame, failing: Column, hold_ms: int, step_ms: int = MINUTE_MS,
                 keys: Sequence[str] = (), chunk_ms: int = CHUNK_MS) -> DataFrame:
    """Maximal runs of consecutive failing points that last ``hold_ms`` or longer: keys,
    started_at, ended_at (first and last failing point), points, fired_at (started_at + hold).

    Gaps and islands in two levels.  Within a chunk of time, failing points minus their row
    number agree exactly within a run, so runs come from windows over (keys, chunk), which are
    no larger than the chunk.  Only runs that touch a chunk's end can go on in the next one:
    those, two a chunk at most, are then joined over all chunks of a key."""
    bad = points.filter(failing).select(*keys, "point").withColumn("chunk", F.floor(F.col("point") / chunk_ms))
    order = W.partitionBy(*keys, "chunk").orderBy("point")
    island = bad.withColumn("island", F.col("point") - F.row_number().over(order) * F.lit(step_ms))
    local = island.groupBy(*keys, "chunk", "island").agg(F.min("point").alias("lo"), F.max("point").alias("hi"))
    touches = (F.col("lo") - step_ms < F.col("chunk") * chunk_ms) | (F.col("hi") + step_ms >= (F.col("chunk") + 1) * chunk_ms)
    local = local.withColumn("alone", F.when(~touches, F.col("lo")))  # null for all that touch
    ordered = W.partitionBy(*keys, "alone").orderBy("lo")
    opens = (F.col("lo") - F.lag("hi").over(ordered) > step_ms) | F.lag("hi").over(ordered).isNull()
    runs = local.withColumn("opens", opens.cast("int")).withColumn("run", F.sum("opens").over(ordered.rowsBetween(W.unboundedPreceding, W.currentRow)))
    whole = runs.groupBy(*keys, "alone", "run").agg(F.min("lo").alias("started_at"), F.max("hi").alias("ended_at"))
    return (whole.filter(F.col("ended_at") - F.col("started_at") >= hold_ms)
            .select(*keys, "started_at", "ended_at", ((F.col("ended_at") - F.col("started_at")) / step_ms + 1).cast("long").alias("points"),
                    (F.col("started_at") + hold_ms).alias("fired_at")))


def range_frames(rows: DataFrame, key: str, at: str, frames: dict[str, tuple[int, int, Sequence[str]]], chunk_ms: int = CHUNK_MS) -> DataFrame:
    """For every row, sums over RANGE frames of its key's rows: ``frames`` maps a name to
    (from, to, columns), the frame being (at + from, at + to] in ms with from < to <= 0.

    A window over a whole key would put all rows of a hot key into one task and sort them
    there.  Rows are therefore also copied into the later chunks of time whose frames reach
    back to them, and the window runs over (key, chunk): as large as the chunk and the reach,
    however long the history."""
    reach = max(-lo for lo, _, _ in frames.values())
    chunk = F.floor(F.col(at) / chunk_ms)
    last = F.floor((F.col(at) + reach) / chunk_ms)
    dealt = rows.withColumn("_own", chunk).withColumn("_chunk", F.explode(F.sequence(chunk, last)))
    order = W.partitionBy(key, "_chunk").orderBy(at)
    sums = {f"{name}_{c}": F.sum(c).over(order.rangeBetween(lo + 1, hi)) for name, (lo, hi, cols) in frames.items() for c in cols}
    return dealt.withColumns(sums).filter("_chunk = _own").drop("_own", "_chunk")
