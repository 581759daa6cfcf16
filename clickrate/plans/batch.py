"""The batch job: raw records of both sources → (valid events, dead letters)
→ union → windowed counts → CTR rows.  Identical column logic to the stream
job; only the source and sink differ."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from clickrate.operators.parse import dead_letters, parse_payloads, valid_events
from clickrate.operators.union import union_events
from clickrate.operators.window_agg import DEFAULT_WINDOW, compute_ctr
from clickrate.session import configure
from clickrate.sources.events_adapter import load_events, raw_records


@dataclass
class ParsedSources:
    parsed: DataFrame  # every record, with envelope columns

    def valid(self) -> DataFrame:
        return valid_events(self.parsed)

    def dlq(self) -> DataFrame:
        return dead_letters(self.parsed)

    def source(self, name: str) -> DataFrame:
        return self.valid().filter(F.col("source") == name)


def parse_sources(raw: DataFrame) -> ParsedSources:
    """P1/P7 over (source, value) records of any number of sources."""
    return ParsedSources(parse_payloads(raw))


def events_to_parsed(spark: SparkSession, sf_dir: str, product_buckets: int | None = None) -> ParsedSources:
    configure(spark)
    return parse_sources(raw_records(load_events(spark, sf_dir), product_buckets))


def ctr_from_parsed(parsed: ParsedSources, window: str = DEFAULT_WINDOW) -> DataFrame:
    """A1-A3 over the valid events of all sources in ``parsed``."""
    return compute_ctr(parsed.valid(), window)


def ctr_from_streams(impressions_raw: DataFrame, clicks_raw: DataFrame,
                     window: str = DEFAULT_WINDOW) -> DataFrame:
    """The job's shape: each source parsed on its own, valid events unioned
    (U1, F1), then A1-A3."""
    imps = valid_events(parse_payloads(impressions_raw))
    clks = valid_events(parse_payloads(clicks_raw))
    return compute_ctr(union_events(imps, clks), window)


def batch_ctr(spark: SparkSession, sf_dir: str, window: str = DEFAULT_WINDOW,
              product_buckets: int | None = None) -> DataFrame:
    """One scan and one parse of the records of both sources, then A1-A3."""
    return ctr_from_parsed(events_to_parsed(spark, sf_dir, product_buckets), window)
