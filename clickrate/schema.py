"""Fixed schemas (nothing is inferred)."""

from pyspark.sql import types as T

# Fields of one event payload, in payload order.
PAYLOAD_FIELDS = ("event_id", "event_type", "product_id", "user_id", "timestamp", "session_id")

# Wire schema for the JSON decode: every field as the text of its token, plus
# the corrupt-record column of PERMISSIVE mode.
CORRUPT_COL = "_corrupt"
WIRE_SCHEMA = T.StructType(
    [T.StructField(f, T.StringType(), True) for f in PAYLOAD_FIELDS]
    + [T.StructField(CORRUPT_COL, T.StringType(), True)]
)
# The same fields as VARIANT, which keeps the JSON type of the token.
TYPE_PROBE_SCHEMA = T.StructType([T.StructField(f, T.VariantType(), True) for f in PAYLOAD_FIELDS])

EVENT_SCHEMA = T.StructType([
    T.StructField("event_id", T.StringType(), True),
    T.StructField("event_type", T.StringType(), True),
    T.StructField("product_id", T.StringType(), True),
    T.StructField("user_id", T.StringType(), True),
    T.StructField("timestamp", T.LongType(), True),  # epoch ms, UTC
    T.StructField("session_id", T.StringType(), True),
])

# Raw input rows, shaped like a topic record: which source, and the value.
RAW_SCHEMA = T.StructType([
    T.StructField("source", T.StringType(), False),
    T.StructField("value", T.BinaryType(), True),
])

# One CTR row per product and window; bounds are epoch ms.
CTR_RESULT_SCHEMA = T.StructType([
    T.StructField("product_id", T.StringType(), False),
    T.StructField("impressions", T.LongType(), False),
    T.StructField("clicks", T.LongType(), False),
    T.StructField("ctr", T.DoubleType(), False),
    T.StructField("window_start", T.LongType(), False),
    T.StructField("window_end", T.LongType(), False),
])

# Column order of the sink insert.
SINK_COLUMNS = ("product_id", "ctr", "impressions", "clicks", "window_start", "window_end")

DLQ_SCHEMA = T.StructType([
    T.StructField("source", T.StringType(), False),
    T.StructField("raw", T.BinaryType(), True),
    T.StructField("error_message", T.StringType(), True),
    T.StructField("stack_trace", T.StringType(), True),
    T.StructField("line", T.StringType(), True),
    T.StructField("processing_time", T.TimestampType(), True),
])

# Stored result table (append log of emitted rows), partitioned by month.
RAW_TABLE_SCHEMA = T.StructType([
    T.StructField("product_id", T.StringType(), False),
    T.StructField("ctr", T.DoubleType(), False),
    T.StructField("impressions", T.LongType(), False),
    T.StructField("clicks", T.LongType(), False),
    T.StructField("window_start", T.TimestampType(), False),
    T.StructField("window_end", T.TimestampType(), False),
    T.StructField("inserted_at", T.TimestampType(), False),
    T.StructField("window_month", T.IntegerType(), False),
])

# Mergeable minute-rollup parts.
MINUTE_PARTS_SCHEMA = T.StructType([
    T.StructField("product_id", T.StringType(), False),
    T.StructField("window_minute", T.TimestampType(), False),
    T.StructField("ctr_sum", T.DoubleType(), False),
    T.StructField("ctr_n", T.LongType(), False),
    T.StructField("impressions", T.LongType(), False),
    T.StructField("clicks", T.LongType(), False),
    T.StructField("latest_window", T.TimestampType(), True),
])

LATEST_SCHEMA = T.StructType([
    T.StructField("product_id", T.StringType(), False),
    T.StructField("latest_ctr", T.DoubleType(), False),
    T.StructField("latest_impressions", T.LongType(), False),
    T.StructField("latest_clicks", T.LongType(), False),
    T.StructField("window_end", T.TimestampType(), False),
])
