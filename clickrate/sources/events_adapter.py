"""Test-data adaptation: the driver's ``events`` table → raw payload records.

Each event becomes one JSON payload on one of two sources, the way the
producers publish them: ``click`` rows go to the ``Click`` source, all other
rows to the ``Impression`` source.  The mapping:

* ``product_id`` = ``'product' || props.k`` (``k % buckets`` when
  ``product_buckets`` is given, so windows hold several events);
* ``timestamp`` = floor of ``ts`` in epoch ms, rendered in the three shapes
  the decoder accepts (JSON number / integer string / ISO instant), chosen by
  ``event_id % 3`` so all three paths run at volume;
* ``user_id`` and ``event_id`` as text;
* ``error`` rows are published as broken JSON (the object is cut before its
  closing brace), so the decode-error path runs as well; ``purchase`` and
  ``signup`` rows decode but fail validation;
* the record's arrival time, where a job asks for it, is ``ts`` plus the
  size of ``value`` in seconds.

Everything is a column expression: the adapter scales with the table.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

IMPRESSION_SOURCE = "Impression"
CLICK_SOURCE = "Click"
# The event type published as a broken payload.
BROKEN_TYPE = "error"


def load_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/events.parquet")


def event_ms(ts: Column) -> Column:
    """Floor of a (NTZ or UTC) timestamp in epoch ms."""
    return F.unix_millis(ts.cast("timestamp"))


def product_of(props: Column, product_buckets: int | None = None) -> Column:
    k = F.get_json_object(props, "$.k")
    if product_buckets:
        k = F.pmod(k.cast("long"), F.lit(product_buckets)).cast("string")
    return F.concat(F.lit("product"), k)


def payload_json(events: DataFrame, product_buckets: int | None = None, keep: tuple[str, ...] = ()) -> DataFrame:
    """Adds ``source``, ``ts_ms``, ``product_id`` and the payload ``json`` text; columns ``keep`` stay."""
    ms = event_ms(F.col("ts"))
    base = events.select(
        "event_id", "event_type", "user_id", "ts",
        product_of(F.col("props"), product_buckets).alias("product_id"),
        ms.alias("ts_ms"),
        *keep,
    )
    fields = [
        F.col("event_id").cast("string").alias("event_id"),
        F.col("event_type"),
        F.col("product_id"),
        F.col("user_id").cast("string").alias("user_id"),
    ]
    iso = F.date_format(F.timestamp_millis(F.col("ts_ms")), "yyyy-MM-dd'T'HH:mm:ss.SSS'Z'")
    shape = F.pmod(F.col("event_id"), F.lit(3))
    as_number = F.to_json(F.struct(*fields, F.col("ts_ms").alias("timestamp")))
    as_string = F.to_json(F.struct(
        *fields,
        F.when(shape == 1, F.col("ts_ms").cast("string")).otherwise(iso).alias("timestamp")))
    whole = F.when(shape == 0, as_number).otherwise(as_string)
    text = F.when(F.col("event_type") == BROKEN_TYPE,
                  F.expr("substring(_whole, 1, length(_whole) - 1)")).otherwise(F.col("_whole"))
    return (base.withColumn("_whole", whole)
            .select(
                F.when(F.col("event_type") == "click", F.lit(CLICK_SOURCE))
                 .otherwise(F.lit(IMPRESSION_SOURCE)).alias("source"),
                "event_id", "event_type", "product_id", "user_id", "ts_ms",
                text.alias("json"),
                *keep,
            ))


def raw_records(events: DataFrame, product_buckets: int | None = None) -> DataFrame:
    """(source, value binary) rows, like records read from two topics."""
    return payload_json(events, product_buckets).select(
        "source", F.encode(F.col("json"), "UTF-8").alias("value"))


def raw_streams(events: DataFrame, product_buckets: int | None = None) -> tuple[DataFrame, DataFrame]:
    """The two sources as separate DataFrames (impressions, clicks)."""
    # Split on the scan's own column, in a form Parquet accepts as a pushed
    # filter (the derived ``source`` column would be evaluated after the scan).
    is_click = F.col("event_type") == "click"
    imps = events.filter(~is_click | F.col("event_type").isNull())
    clks = events.filter(is_click)
    return raw_records(imps, product_buckets), raw_records(clks, product_buckets)


def arrival_records(events: DataFrame, product_buckets: int | None = None) -> DataFrame:
    """(source, value binary, arrived_at) rows, like records with the time a topic got them."""
    delay = F.floor(F.abs("value") * 1000 + 0.5).cast("long")
    arrived = events.select("event_id", F.timestamp_millis(event_ms(F.col("ts")) + F.coalesce(delay, F.lit(0))).alias("arrived_at"), "event_type", "user_id", "ts", "props")
    return payload_json(arrived, product_buckets, keep=("arrived_at",)).select("source", F.encode(F.col("json"), "UTF-8").alias("value"), "arrived_at")


def gappy_records(events: DataFrame) -> DataFrame:
    """(event_id, source, value binary) rows in which ``event_id % 12`` leaves out or blanks
    fields: no user (0), blank user (1), null product (2), blank product (3), no type (4), blank
    type (5), no user, no product and a type in the wrong case (6), null timestamp (7), an object
    that is cut (8); the rest are whole."""
    shape = F.pmod("event_id", F.lit(12))
    k = F.get_json_object("props", "$.k")
    json = F.to_json(F.struct(
        F.col("event_id").cast("string").alias("event_id"),
        F.when(shape.isin(4), F.lit(None)).when(shape == 5, " ").when(shape == 6, "Click").otherwise(F.col("event_type")).alias("event_type"),
        F.when(shape.isin(2, 6), F.lit(None)).when(shape == 3, "\u2003").otherwise(F.concat(F.lit("product"), k)).alias("product_id"),
        F.when(shape.isin(0, 6), F.lit(None)).when(shape == 1, "").otherwise(F.col("user_id").cast("string")).alias("user_id"),
        F.when(shape != 7, event_ms(F.col("ts"))).alias("timestamp")))
    source = F.when(F.col("event_type") == "click", CLICK_SOURCE).otherwise(IMPRESSION_SOURCE)
    return events.select("event_id", source.alias("source"), F.encode(F.when(shape == 8, F.substring(json, 1, 20)).otherwise(json), "UTF-8").alias("value"))


def shaped_records(events: DataFrame) -> DataFrame:
    """(event_id, source, value binary) rows in which ``event_id % 10`` picks a rarer payload
    shape: number tokens as product id (0 with trailing zero, 1 with 41 digits), a byte that is
    no UTF-8 (2), a float (3), 40-digit integer (4) and 40-digit text (5) as timestamp, wall
    clock (6), an instant with an offset of nine hours (7), the year 0 (8), an object as
    product id (9)."""
    ms = event_ms(F.col("ts"))
    k = F.get_json_object("props", "$.k")
    shape = F.pmod("event_id", F.lit(10))
    product = (F.when(shape == 0, F.concat(k, F.lit(".50")))
               .when(shape == 1, F.concat(F.lit("1" * 20), F.lpad(k, 21, "0")))
               .when(shape == 9, F.concat(F.lit('{"k":'), k, F.lit("}")))
               .otherwise(F.concat(F.lit('"product'), k, F.lit('"'))))
    stamp = (F.when(shape == 3, F.concat(ms.cast("string"), F.lit(".0")))
             .when(shape == 4, F.lpad(ms.cast("string"), 40, "7"))
             .when(shape == 5, F.concat(F.lit('"'), F.lpad(ms.cast("string"), 40, "7"), F.lit('"')))
             .when(shape == 6, F.date_format(F.timestamp_millis(ms), "'\"'yyyy-MM-dd HH:mm:ss'\"'"))
             .when(shape == 7, F.date_format(F.timestamp_millis(ms + 9 * 3_600_000),
                                             "'\"'yyyy-MM-dd'T'HH:mm:ss.SSS'+09:00\"'"))
             .when(shape == 8, F.lit('"0000-01-01T00:00:00Z"'))
             .otherwise(ms.cast("string")))
    head = F.concat(F.lit('{"event_type":"'), F.col("event_type"), F.lit('","user_id":"u'))
    tail = F.concat(F.lit('","product_id":'), product, F.lit(',"timestamp":'), stamp, F.lit("}"))
    odd = F.when(shape == 2, F.unhex(F.lit("FF"))).otherwise(F.unhex(F.lit("")))
    return events.select(
        "event_id", F.lit(IMPRESSION_SOURCE).alias("source"),
        F.concat(F.encode(head, "UTF-8"), odd, F.encode(tail, "UTF-8")).alias("value"))
