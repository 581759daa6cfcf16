"""The whole pipeline over edge rows and empty tables, with further columns of clashing names."""

import pytest

import corpus_pipeline

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, rejected boolean, contaminated boolean, piece int"
PROSE = "the river runs past an old mill where two brothers keep their boats and mend the nets each spring"
EDGES = [
    (1, PROSE, "en", "a", 1), (1, PROSE, "en", "a", 1), (2, PROSE + " again", None, None, None), (None, None, None, None, None), (3, "", "en", "a", 0),
    (4, "le vieux moulin se trouve au bord de la rivière et deux frères y gardent leurs bateaux", "fr", "b", 9), (None, "password = hunter2hunter2 " + PROSE[:40], "en", "a", 2),
    (5, " ".join(f"{w} w{i}" for i, w in enumerate(PROSE.split() * 300)), "en", "a", None),
]


@pytest.mark.parametrize("rows", [EDGES, []])
def test_run(spark, tmp_path, rows):
    spark.createDataFrame([(*r, True, True, 7) for r in rows], SCHEMA).repartition(2).write.parquet(str(tmp_path / "documents.parquet"))
    spark.createDataFrame([(1, None), (2, " ")], "item_id long, text string").write.parquet(str(tmp_path / "benchmark.parquet"))
    got = corpus_pipeline.run(spark, str(tmp_path)).collect()
    assert bool(got) == bool(rows)
    assert {r["doc_id"] for r in got} <= {r[0] for r in rows}
    assert sum(r["length"] for r in got if r["doc_id"] == 1 and r["piece"] == 0) == sum(r["length"] for r in got if r["doc_id"] == 1)
    by_sequence = {}
    for r in got:
        by_sequence.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
    for places in by_sequence.values():
        ends = [0]
        for offset, length in sorted(places):
            assert offset == ends[-1]
            ends.append(offset + length)
        assert ends[-1] <= 2048
