"""Decode raw payloads into events and split off dead letters.

One pass of ``from_json`` decodes each payload into text fields; numbers and
booleans keep the text of their token.  Where that text leaves the JSON type
open (it opens like a container, or is an integer too long for 64 bits), a
second decode into VARIANT fields tells the type; other rows skip it.

* string fields accept strings, numbers and booleans (as text); an object or
  array there is a decode error;
* ``timestamp`` follows P2 (integer → ms, string → P2a, others → null); an
  integer token beyond 64 bits is a decode error;
* a payload that is not a JSON object, is empty, is not UTF-8, or whose value
  is missing is a decode error (``Malformed JSON``); the JSON literal ``null``
  decodes to nothing and is reported as ``Invalid event data``.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from clickrate.functions.dlq import dlq_line
from clickrate.functions.timestamps import INTEGER_TEXT, with_timestamp_ms
from clickrate.functions.validity import is_valid
from clickrate.schema import CORRUPT_COL, PAYLOAD_FIELDS, TYPE_PROBE_SCHEMA, WIRE_SCHEMA

# Error texts of the envelope.
INVALID_EVENT = "Invalid event data"
MALFORMED_JSON = "Malformed JSON"

# Decoder settings matching a default strict JSON object mapper: no single
# quotes, no NaN / Infinity literals, no comments.
JSON_OPTIONS = {
    "mode": "PERMISSIVE",
    "columnNameOfCorruptRecord": CORRUPT_COL,
    "allowSingleQuotes": "false",
    "allowNonNumericNumbers": "false",
    "allowComments": "false",
}

# A document that is the JSON literal null (trailing non-identifier text is
# ignored, as a streaming JSON reader stops after the first value).
_NULL_DOCUMENT = r"(?s)^[ \t\r\n]*null([^\p{javaJavaIdentifierPart}].*)?$"

_STRING_FIELDS = tuple(f for f in PAYLOAD_FIELDS if f != "timestamp")


# How the decoder prints a number token that has a fraction or an exponent.
_PRINTED_FLOAT = r'^"?-?([0-9]+\.|[0-9.]+E|Infinity)'


def _token_text(field: str) -> Column:
    """The field's text.  The decoder prints a float token anew (``12.50`` as
    ``12.5``), so for such texts the token itself is cut from the payload: the
    last value of that key that is the same number.  An unescaped quote after
    ``{``, ``,`` or white space opens a key or value, so no string content matches."""
    text = F.col(f"_wire.`{field}`")
    number = F.translate(text, '"', "").try_cast("double")
    tokens = F.regexp_extract_all(
        F.col("_text"), F.lit(rf'(?<=[{{,\s])"{field}"\s*:\s*"?(-?[0-9][0-9.eE+-]*)'), F.lit(1))
    same = F.try_element_at(F.filter(tokens, lambda t: t.try_cast("double") == number), F.lit(-1))
    return F.when(text.rlike(_PRINTED_FLOAT), F.coalesce(same, text)).otherwise(text)


def _opens_container(field: str) -> Column:
    return F.coalesce(F.substring(F.col(f"_f_{field}"), 1, 1).isin("{", "["), F.lit(False))


def _probed_type(field: str) -> Column:
    """JSON type of a probed field; null where the row was not probed."""
    return F.expr(f"schema_of_variant(_probe.`{field}`)")


def parse_payloads(raw: DataFrame, value_col: str = "value", every_event: bool = False) -> DataFrame:
    """Decode ``value_col`` (binary or string) of every row.

    Adds: ``event`` (struct of the six fields, timestamp as epoch ms; null on
    failure; with ``every_event`` only where the payload does not decode), ``raw`` (payload bytes), ``error_message``, ``stack_trace`` and
    ``is_success``.  Other input columns (e.g. ``source``) pass through.

    The work is split into flat projections (decode → field texts → checks
    → envelope) so every costly expression is evaluated once per row: the
    optimizer does not inline a non-trivial column that is used twice.
    """
    value_type = raw.schema[value_col].dataType
    is_binary = isinstance(value_type, T.BinaryType)
    text = F.col(value_col).cast("string") if is_binary else F.col(value_col)
    raw_bytes = F.col(value_col) if is_binary else F.encode(F.col(value_col), "UTF-8")
    keep = [c for c in raw.columns if c != value_col]

    decoded = raw.select(
        *keep,
        raw_bytes.alias("raw"),
        text.alias("_text"),
        F.from_json(text, WIRE_SCHEMA, JSON_OPTIONS).alias("_wire"),
    )
    fields = decoded.select(
        *keep, "raw", "_text", "_wire",
        *[_token_text(f).alias(f"_f_{f}") for f in _STRING_FIELDS],
        F.col("_wire.timestamp").alias("_f_timestamp"),
    )
    fields = with_timestamp_ms(fields, "_f_timestamp", "_ts_ms")
    long_integer = F.coalesce(F.col("_f_timestamp").rlike(INTEGER_TEXT) & F.col("_ts_ms").isNull(), F.lit(False))
    fields = fields.withColumn("_long_integer", long_integer)
    open_type = reduce(lambda a, b: a | b, [_opens_container(f) for f in _STRING_FIELDS]) | F.col("_long_integer")
    probed = fields.withColumn("_probe", F.when(open_type, F.from_json("_text", TYPE_PROBE_SCHEMA, JSON_OPTIONS)))
    checked = probed.select(
        *keep, "raw",
        *[F.col(f"_f_{f}") for f in _STRING_FIELDS],
        "_ts_ms",
        # An integer token beyond 64 bits is a decode error; an integer
        # string beyond 64 bits is merely no timestamp.
        (F.col("_long_integer") & ~F.coalesce(_probed_type("timestamp") == "STRING", F.lit(True))).alias("_ts_overflow"),
        reduce(lambda a, b: a | b, [
            _opens_container(f) & F.coalesce(_probed_type(f).rlike("^(OBJECT|ARRAY)"), F.lit(False))
            for f in _STRING_FIELDS]).alias("_container"),
        (F.col("_text").isNull() | ~F.is_valid_utf8("_text") | F.col("_wire").isNull()
         | (F.col(f"_wire.{CORRUPT_COL}").isNotNull()
            & ~F.coalesce(F.col("_text").rlike(_NULL_DOCUMENT), F.lit(False)))).alias("_undecodable"),
    )
    valid = is_valid(F.col("_f_product_id"), F.col("_f_event_type"), F.col("_ts_ms"))
    malformed = F.col("_undecodable") | F.col("_container") | F.col("_ts_overflow")
    flagged = checked.select(
        *keep, "raw",
        *[F.col(f"_f_{f}") for f in _STRING_FIELDS], "_ts_ms",
        F.when(malformed, F.lit(MALFORMED_JSON))
         .when(~valid, F.lit(INVALID_EVENT)).alias("error_message"),
    )
    ok = F.col("error_message").isNull()
    event = F.struct(
        *[F.col(f"_f_{f}").alias(f) for f in _STRING_FIELDS[:4]],
        F.col("_ts_ms").alias("timestamp"),
        F.col("_f_session_id").alias("session_id"),
    )
    envelope = F.struct(
        F.when(~F.col("error_message").eqNullSafe(MALFORMED_JSON) if every_event else ok, event).alias("event"),
        F.col("raw"),
        F.col("error_message"),
        F.lit(None).cast("string").alias("stack_trace"),
        ok.alias("is_success"),
    )
    # Optimizer barrier: the envelope leaves through a generator, so filters
    # on its columns (is_success, event fields, event time) stay above it
    # instead of being pushed down with every parse expression inlined into
    # them.  Filters on pass-through columns (``source``) still reach the scan.
    return flagged.select(*keep, F.inline(F.array(envelope)))


def valid_events(parsed: DataFrame) -> DataFrame:
    """F2, success side: one row per valid event with the event fields flat."""
    keep = [c for c in parsed.columns if c not in ("event", "raw", "error_message", "stack_trace", "is_success")]
    return parsed.filter(F.col("is_success")).select(*keep, "event.*")


def dead_letters(parsed: DataFrame, source_col: str = "source") -> DataFrame:
    """F2, failure side, with the P16 log line and processing time."""
    return parsed.filter(~F.col("is_success")).select(
        F.col(source_col).alias("source"),
        "raw",
        "error_message",
        "stack_trace",
        dlq_line(F.col(source_col), F.col("error_message"), F.col("raw")).alias("line"),
        F.current_timestamp().alias("processing_time"),
    )
