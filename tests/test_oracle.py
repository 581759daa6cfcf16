"""Every registered query of the engine against its DuckDB oracle on sf0.001."""

import pytest

import __spark_entry__ as E
from clickrate.plans.registry import HELD_EVERY, ORACLE_SQL, QUERIES
from tests.oracle import compare, duck

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def con():
    return duck(SF)


@pytest.mark.parametrize("name", QUERIES)
def test_query_matches_oracle(spark, con, name):
    df = QUERIES[name](spark, SF)
    problems, _ = compare(df, con, ORACLE_SQL[name])
    assert not problems, problems


def test_late_rows_are_dropped_only_behind_the_watermark(spark, con):
    counted = {name: con.execute(f"SELECT sum(impressions + clicks), count(*) FILTER (ctr > 0) FROM ({ORACLE_SQL[name]})").fetchone()
               for name in ("stream_late_rows", "stream_append_final")}
    valid, held = con.execute(f"""SELECT count(*), count(*) FILTER (CAST(event_id AS BIGINT) % {HELD_EVERY} = 0)
        FROM ({ORACLE_SQL['parsed_valid_events']})""").fetchone()
    n, with_ratio = counted["stream_late_rows"]
    assert 0 < valid - n <= held and with_ratio > 0
    assert counted["stream_append_final"][0] < n


def test_entry_runs(spark):
    df = E.entry(spark)
    assert df.columns == ["product_id", "impressions", "clicks", "ctr", "window_start", "window_end"]
    assert df.count() > 0
