"""Dead-letter log line."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def dlq_line(prefix: Column, error_message: Column, raw: Column) -> Column:
    """``DLQ [<prefix>]: <error>, Data: <raw as UTF-8>`` (absent parts print
    as ``null``; bytes that are no UTF-8 as the replacement character)."""
    return F.format_string(
        "DLQ [%s]: %s, Data: %s",
        prefix,
        F.coalesce(error_message, F.lit("null")),
        F.coalesce(F.make_valid_utf8(raw.cast("string")), F.lit("null")),
    )
