"""Event timestamp normaliser.

A JSON integer is taken as epoch milliseconds.  A JSON string is tried, in
order, as: integer text; ``yyyy-MM-dd HH:mm:ss`` (UTC, smart resolution);
ISO-8601 instant.  Anything else (float, bool, object, blank) gives null.
Regex guards run first so Spark's lenient casts never accept a shape the
contract rejects (leading blanks, date-only text, missing zone ...).

The normaliser is a staged DataFrame transform rather than one Column: the
text is classified once, the date fields are cut out once by position (both
date shapes share the first 19 characters), and the calendar arithmetic then
works on those columns.  Built as a single nested Column, every field would
be re-extracted in every place it is used.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

MS_PER_DAY = 86_400_000
# Largest |ms| that still converts to a Spark timestamp (micros in a long).
MAX_ABS_MS = 9_223_372_036_854_775

# Fixed patterns of the accepted text shapes.
INTEGER_TEXT = r"^[+-]?[0-9]+$"
WALL_CLOCK_TEXT = r"^[0-9]{4}-[0-9]{2}-[0-9]{2} [0-9]{2}:[0-9]{2}:[0-9]{2}$"
ISO_INSTANT_TEXT = (
    r"^[0-9]{4}-[0-9]{2}-[0-9]{2}[Tt][0-9]{2}:[0-9]{2}:[0-9]{2}"
    r"(\.[0-9]{0,9})?([Zz]|[+-][0-9]{2}:[0-9]{2}(:[0-9]{2})?)$"
)
_FRACTION = r"^\.([0-9]*)"
_OFFSET = r"([+-])([0-9]{2}):([0-9]{2})(?::([0-9]{2}))?$"

_INT, _WALL, _ISO = 1, 2, 3


def _is_leap(y: Column) -> Column:
    return ((y % 4 == 0) & (y % 100 != 0)) | (y % 400 == 0)


def _days_in_month(y: Column, m: Column) -> Column:
    return (F.when(m == 2, F.when(_is_leap(y), 29).otherwise(28))
            .when(m.isin(4, 6, 9, 11), 30).otherwise(31))


def with_timestamp_ms(df: DataFrame, text_col: str, out_col: str) -> DataFrame:
    """Add ``out_col`` (epoch ms or null) parsed from ``text_col``.

    * integer text → the integer (null beyond 64 bits);
    * wall-clock text, read as UTC with smart resolution: a day past the month
      end is clamped to its last day, ``24:00:00`` is the next midnight, other
      out-of-range fields are rejected;
    * ISO instant: strict calendar date, optional fraction (cut to ms), ``Z``
      or ``±HH:MM[:SS]`` offset up to 18 h; ``24:00:00`` is the next midnight
      and a leap second 60 reads as 59.
    """
    t = F.col(text_col)
    date_like = (F.length(t) >= 19) & F.substring(t, 1, 1).between("0", "9")
    kind = (F.when(t.rlike(INTEGER_TEXT), F.lit(_INT))
            .when(date_like & t.rlike(WALL_CLOCK_TEXT), F.lit(_WALL))
            .when(date_like & t.rlike(ISO_INSTANT_TEXT), F.lit(_ISO)))
    staged = df.withColumn("_ts_kind", kind)

    k = F.col("_ts_kind")
    is_date = k >= _WALL
    tail = F.substring(t, 20, 64)

    def num(pos: int, n: int) -> Column:
        return F.when(is_date, F.substring(t, pos, n).cast("int"))

    # The shape regexes have validated every digit position, so plain casts
    # below never fail (failed casts are costly even under try_cast).
    staged = staged.withColumn("_ts_off", F.when(k == _ISO, F.regexp_extract(tail, _OFFSET, 0)))
    offset = F.col("_ts_off")
    has_offset = F.length(offset) >= 6

    def off_part(pos: int) -> Column:
        return F.when(k == _ISO, F.when(F.length(offset) >= pos + 1, F.substring(offset, pos, 2).cast("int"))
                      .otherwise(0))

    staged = staged.withColumns({
        "_ts_int": F.when(k == _INT, t.try_cast("long")),
        "_ts_y": num(1, 4), "_ts_mo": num(6, 2), "_ts_d": num(9, 2),
        "_ts_h": num(12, 2), "_ts_mi": num(15, 2), "_ts_s": num(18, 2),
        "_ts_frac": F.when(k == _ISO, F.rpad(F.regexp_extract(tail, _FRACTION, 1), 9, "0")),
        "_ts_off_neg": F.when(k == _ISO, has_offset & (F.substring(offset, 1, 1) == "-")),
        "_ts_off_h": off_part(2), "_ts_off_m": off_part(5), "_ts_off_s": off_part(8),
    })

    y, mo, d = F.col("_ts_y"), F.col("_ts_mo"), F.col("_ts_d")
    h, mi, sec = F.col("_ts_h"), F.col("_ts_mi"), F.col("_ts_s")
    frac = F.col("_ts_frac")
    off_h, off_m, off_s = F.col("_ts_off_h"), F.col("_ts_off_m"), F.col("_ts_off_s")
    iso = k == _ISO
    frac_ms = F.when(iso, F.substring(frac, 1, 3).cast("int")).otherwise(0)
    end_of_day = (h == 24) & (mi == 0) & (sec == 0) & F.coalesce(frac == "000000000", F.lit(True))
    leap = iso & (h == 23) & (mi == 59) & (sec == 60)
    off_total = F.coalesce(off_h * 3600 + off_m * 60 + off_s, F.lit(0))
    off_ms = (F.when(F.col("_ts_off_neg"), -1000).otherwise(1000) * off_total).cast("long")
    ok = (is_date & ((y >= 1) | iso) & d.between(1, 31) & (h.between(0, 23) | end_of_day)
          & mi.between(0, 59) & (sec.between(0, 59) | leap)
          & F.coalesce((off_m <= 59) & (off_s <= 59) & (off_total <= 18 * 3600), F.lit(True)))
    # Smart resolution clamps a wall-clock day to the month end; an ISO
    # instant needs a real calendar day (the constructor rejects others).
    day = F.when(iso, d).otherwise(F.least(d, _days_in_month(y, mo)))
    midnight_or_time = F.expr(
        "try_make_timestamp(_ts_y, _ts_mo, _day, _ts_h % 24, _ts_mi, _sec, 'UTC')")
    staged = staged.withColumns({
        "_ok": ok, "_day": day, "_sec": F.when(leap, 59).otherwise(sec),
        "_extra_ms": (F.when(end_of_day, MS_PER_DAY).otherwise(0) + F.when(iso, frac_ms).otherwise(0)
                      - F.when(iso, off_ms).otherwise(0)).cast("long"),
    })
    value = F.coalesce(F.col("_ts_int"),
                       F.when(F.col("_ok"), F.unix_millis(midnight_or_time) + F.col("_extra_ms")))
    helpers = ["_ts_kind", "_ts_int", "_ts_y", "_ts_mo", "_ts_d", "_ts_h", "_ts_mi", "_ts_s",
               "_ts_frac", "_ts_off", "_ts_off_neg", "_ts_off_h", "_ts_off_m", "_ts_off_s",
               "_ok", "_day", "_sec", "_extra_ms"]
    return staged.withColumn(out_col, value).drop(*helpers)


def event_time(ms: Column) -> Column:
    """Epoch ms → timestamp, null where Spark cannot represent it."""
    return F.when(ms.between(-MAX_ABS_MS, MAX_ABS_MS), F.timestamp_millis(ms))
