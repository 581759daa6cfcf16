"""Chat formatting, whitening and lexical search against SQL, brute force and exact round trips."""

import hashlib

import duckdb
import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

import corpus_pipeline
from clickrate.llm import chat, lexical, packing, quality, queries, whitening
from tests.oracle import compare, duck

SF = "/root/testdata/sf0.001"

# -- chat formatting ------------------------------------------------------------------------------

TURNS = [
    (1, 0, "system", "be <|im_end|> kind"), (1, 1, "user", "see ![a cat](http://x/y.png) and [song](z.mp3)![](q)"), (1, 2, "assistant", "a [paper](p.pdf), <\\|im_start|> <\\\\|x|"),
    (2, 0, "user", None), (2, 1, "assistant", ""), (2, 1, "assistant", ""), (2, 1, "assistant", "tie"), (2, None, "user", "first"),
    (None, 0, "assistant", "no id"), (3, 0, None, "no role\r\n"), (3, 1, "a\nb\\n<|", "role\n"), (4, 0, "assistant", "word " * 60_000 + "\U0001f600<"),
    (5, 0, "user", "[x](a b.mp3) [y](http://h/page) ![" + "z" * 201 + "](r) <|image|> ![<](r)"), (5, 1, "assistant", "<![i](r)|im_end|>"),
]


def table_of(spark, rows, schema, path):
    spark.createDataFrame(rows, schema).coalesce(1).write.parquet(path)
    return path


def test_chat_sql(spark, tmp_path):
    d = str(tmp_path)
    table_of(spark, [r + ("p", "f") for r in TURNS], "conv_id long, turn long, role string, text string, parts string, formatted string", f"{d}/conversations.parquet")
    con = duckdb.connect()
    con.execute(f"CREATE VIEW conversations AS SELECT * FROM read_parquet('{d}/conversations.parquet/*.parquet')")
    assert not compare(queries.QUERIES["op11_chat_formatting"](spark, d), con, chat.OP11_SQL)[0]
    assert not compare(queries.QUERIES["op11_chat_formatting"](spark, SF), duck(SF), chat.OP11_SQL)[0]


def test_chat_empty_table(spark, tmp_path):
    d = str(tmp_path)
    table_of(spark, [], "conv_id long, turn long, role string, text string", f"{d}/conversations.parquet")
    rows = queries.QUERIES["op11_chat_formatting"](spark, d).collect()
    assert [(r.conv_id, r.n_turns) for r in rows] == [(-1, 2)]
    said = chat.HOSTILE
    assert rows[0].turns_sha256 == hashlib.sha256(f"user\n{said}\nassistant\n{said}\n".encode()).hexdigest()
    assert (rows[0].loss_chars, rows[0].loss_sha256) == (len(said), hashlib.sha256(said.encode()).hexdigest())


@settings(max_examples=300, deadline=None)
@given(st.text(alphabet="<|\\>n\na![](x).mp3im_endimage", max_size=40), st.text(alphabet="<|\\\nan>", max_size=10))
def test_chat_round_trip(text, role):
    flat = chat.flatten(chat.parts_of(text))
    turn, start, end = chat.turn_text(role, flat.text)
    assert chat.read_turn(turn, flat.attachments) == (role, text)
    assert chat._MARK.findall(turn) == ["im_start", *(a["type"] for a in flat.attachments), "im_end"]
    assert (end > start) <= (role == "assistant")


def test_chat_typed_parts(spark):
    parts = [{"type": "text", "text": "look: <|image|>"}, {"type": "image", "ref": "a.png", "width": 57, "height": 28}, {"type": "audio", "ref": "b", "seconds": 2.01},
             {"type": "document", "ref": None, "pages": 3}, {"type": "video", "text": "[clip]"}, {"type": None, "text": None}, {"type": "image"}]
    df = spark.createDataFrame([(1, 0, "assistant", parts), (1, 1, "user", None)], f"conv_id long, turn int, role string, parts array<struct<{chat._struct(chat.PART)}>>")
    one, two = chat.formatted(df, vocabulary=chat_vocabulary()).orderBy("turn").collect()
    assert one.formatted == "<|im_start|>assistant\nlook: <\\|image|><|image|><|audio|><|document|>[clip]<|image|><|im_end|>\n"
    assert one.formatted[one.loss_start:one.loss_end] == one.formatted[len("<|im_start|>assistant\n"):-len("<|im_end|>\n")]
    assert [(a.place, a.type, a.ref, a.tokens) for a in one.attachments] == [(0, "image", "a.png", 3), (1, "audio", "b", 51), (2, "document", "", 3072), (3, "image", "", 256)]
    from tokenizers import Tokenizer
    import public_tokenizers
    tok = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    texts = ["assistant\nlook: <\\|image|>", "[clip]", "\n"]
    assert one.n_tokens == 3 + 51 + 3072 + 256 + 2 + sum(len(tok.encode(t, add_special_tokens=False).ids) for t in texts)
    assert two.formatted == "<|im_start|>user\n<|im_end|>\n" and two.loss_start == two.loss_end


def chat_vocabulary():
    from clickrate.llm.tokens import VOCABULARY
    return VOCABULARY


# -- whitening ------------------------------------------------------------------------------------

@pytest.mark.parametrize("kind", ["random", "equal values", "zero weights", "close values", "zero update"])
@pytest.mark.parametrize("m", [1, 2, 7, 48])
def test_rank_one(m, kind):
    rng = np.random.default_rng(m)
    d, z, rho = np.sort(rng.random(m)) * 1e4, rng.normal(size=m) * 30, 0.9
    if kind == "equal values":
        d[:] = np.repeat(d, 3)[:m]
    elif kind == "zero weights":
        z[::2] = 0
    elif kind == "close values":
        d = 1 + np.arange(m) * 1e-13
    elif kind == "zero update":
        z[:] = 0
    values, turn = whitening.rank_one(d, z, rho)
    whole = np.diag(d) + rho * np.outer(z, z)
    scale = np.abs(whole).max()
    assert np.abs(turn.T @ turn - np.eye(m)).max() < 1e-13
    assert np.abs(turn @ np.diag(values) @ turn.T - whole).max() < 1e-13 * scale * m
    assert np.abs(values - np.linalg.eigvalsh(whole)).max() < 1e-13 * scale * m


def test_spectra_combine_to_the_whole():
    rng = np.random.default_rng(5)
    x = (rng.normal(size=(700, 12)) * np.linspace(1, 300, 12)).astype(np.int64) + 100_000
    x[:, 11] = 7  # a dimension without variance
    parts = [whitening.Spectrum.empty(12) for _ in range(4)]
    for s, rows in zip(parts, (x[:1], x[1:300], x[300:300], x[300:])):
        s.add_rows(rows)
    whole = parts[0]
    for s in parts[1:]:
        whole.combine(whitening.Spectrum.of(s.row(3)))
    y = x - x.mean(0)
    assert whole.n == 700 and whole.sums == [int(v) for v in x.sum(0)]
    assert np.allclose(whole.mean, x.mean(0), rtol=1e-13)
    assert np.abs(whole.basis @ np.diag(whole.values) @ whole.basis.T - y.T @ y).max() < 1e-10 * np.abs(y.T @ y).max()


def brute_whitening(vectors, k=8):
    x = np.floor(1024 * np.array(vectors, dtype=float)).astype(int) + 100_000
    n, s = len(x), x.sum(0)
    y = (n * x - s) / n
    values, vecs = np.linalg.eigh(y.T @ y / n)
    order = np.argsort(-values)[:k]
    return ((n * x - s) ** 2).sum(1), y @ vecs[:, order] / np.sqrt(values[order]), values[order] / values.sum()


def test_whitening_against_numpy(spark):
    found = queries.QUERIES["op12_embedding_whitening"](spark, SF).toPandas()
    rows = spark.read.parquet(f"{SF}/embeddings.parquet").select("vec_id", "embedding").orderBy("vec_id").collect()
    deviation, whitened, explained = brute_whitening([r.embedding for r in rows])
    wide = found.pivot(index="vec_id", columns="component", values="whitened").sort_index()
    assert list(wide.columns) == list(range(1, 9)) and list(wide.index) == [r.vec_id for r in rows]
    mine = wide.to_numpy()
    sign = np.sign((mine * whitened).sum(0))
    assert np.abs(mine * sign - whitened).max() < 1e-9
    one = found[found.component == 1].set_index("vec_id").sort_index()
    assert one.deviation.tolist() == deviation.tolist() and set(found.n) == {len(rows)}
    assert np.allclose(found.groupby("component").explained.first(), explained, rtol=1e-12)
    assert found.identity_error.nunique() == 1 and found.identity_error.iloc[0] < 1e-10


def test_whitening_edge_rows(spark, tmp_path):
    rng = np.random.default_rng(2)
    good = [(i % 25, rng.normal(size=3).tolist()) for i in range(40)] + [(99, [1.5, 2.5, -3.0])] * 30
    bad = [(200, None), (201, [1.0, None, 2.0]), (202, [1.0, float("nan"), 2.0]), (203, [float("inf"), 0.0, 0.0]), (204, []), (205, [1.0, 2.0]), (206, [1.0] * 4)]
    rows = [(i, v, i) for i, v in [*good, (None, [0.25, 0.5, 0.75]), *bad]]
    schema = "vec_id long, embedding array<double>, part int"
    df = spark.createDataFrame(rows, schema).repartition(5)
    out = whitening.whiten(df, whitening.fit(spark, df)).toPandas()
    vectors = [v for _, v in good] + [[0.25, 0.5, 0.75]]
    deviation, _, explained = brute_whitening(vectors, 3)
    assert len(out) == 3 * len(vectors) and out.vec_id.isna().sum() == 3
    assert sorted(out[out.component == 2].deviation) == sorted(deviation.tolist())
    assert np.allclose(out.groupby("component").explained.first(), explained, rtol=1e-10)
    assert out.identity_error.max() < 1e-10
    for few in ([], bad[:5], [(1, [1.0, 2.0])] * 3):  # nothing, nothing usable, no variance
        small = spark.createDataFrame([(i, v, i) for i, v in few], schema)
        assert whitening.whiten(small, whitening.fit(spark, small)).collect() == []
    table_of(spark, [], schema, f"{tmp_path}/embeddings.parquet")
    assert queries.QUERIES["op12_embedding_whitening"](spark, str(tmp_path)).collect() == []


def test_whitening_sums_beyond_64_bits():
    x = np.array([[2 ** 51, -(2 ** 51)], [2 ** 51 - 1, 3]], dtype=np.int64)
    many = np.repeat(x, 5000, axis=0)
    assert whitening.exact_sum(many) == [5000 * (2 ** 52 - 1), 5000 * (3 - 2 ** 51)]
    apart = whitening.centred(x, 10_000, whitening.exact_sum(many))
    assert apart[0][1] == -10_000 * 2 ** 51 - 5000 * (3 - 2 ** 51)


# -- lexical search -------------------------------------------------------------------------------

DOCS = [
    (1, "One two three, FOUR five"), (2, "one two three, four FIVE"), (2, "one two three, four FIVE"), (3, None), (4, ""), (5, "..., --"), (None, "one two three four five"),
    (6, "Été été café1 one_two"), (7, "two " * 40_000 + "one"), (8, "three three zebra"), (9, "K kelvin"), *[(100 + i, "two three four") for i in range(120)],
]
ITEMS = [(1, "one ONE two zebra?"), (2, "été K"), (2, "café1"), (3, None), (4, "..."), (5, "absent words"), (6, "two three")]


def test_lexical_sql(spark, tmp_path, monkeypatch):
    d = str(tmp_path)
    table_of(spark, [r + ("u", 5) for r in DOCS], "doc_id long, text string, uid string, n int", f"{d}/documents.parquet")
    table_of(spark, [r + ("x",) for r in ITEMS], "item_id long, text string, term string", f"{d}/benchmark.parquet")
    con = duckdb.connect()
    for t in ("documents", "benchmark"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{d}/{t}.parquet/*.parquet')")
    query = queries.QUERIES["op13_ranked_lexical_search"]
    assert not compare(query(spark, d), con, lexical.OP13_SQL)[0]
    assert not compare(query(spark, SF), duck(SF), lexical.OP13_SQL)[0]
    monkeypatch.setattr(lexical, "SHARD_POSTINGS", 40)  # many shards, many blocks of items
    monkeypatch.setattr(lexical, "ITEM_BLOCK", 2)
    assert not compare(query(spark, d), con, lexical.OP13_SQL)[0]


@pytest.mark.parametrize("docs, items", [([], ITEMS), (DOCS, []), ([(1, None)], ITEMS)])
def test_lexical_empty(spark, docs, items):
    found = lexical.ranked(spark, spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string"))
    assert found.collect() == [] and found.columns == ["item_id", "rank", "doc_id", "score"]


@settings(max_examples=200, deadline=None)
@given(st.integers(0, 10 ** 6), st.integers(1, 12), st.integers(1, 6), st.integers(1, 4))
def test_best_positions_against_brute_force(seed, k, n_lists, step):
    rng = np.random.default_rng(seed)
    n = int(rng.integers(1, 200))
    weight = rng.integers(0, int(rng.choice([2, 5, 1000])), size=(n_lists, n)) * (rng.random((n_lists, n)) < 0.6)
    term, doc = np.nonzero(weight)
    shard = lexical.Lists(doc.astype(np.int64), term.astype(np.int64), weight[term, doc].astype(np.int64))
    lists = [x for x in map(shard.of, range(n_lists)) if x]
    docs, scores, _ = lexical.best_positions(lists, k, step, 4 * step)
    keep = lexical.best_of(scores, docs, k)
    total = weight.sum(0)
    want = [d for d in np.lexsort((np.arange(n), -total)) if total[d] > 0][:k]
    assert docs[keep].tolist() == want and scores[keep].tolist() == total[want].tolist()


def test_best_positions_stop_early():
    """Far fewer positions than there are, and fewer than stopping by the last ones read in order needs."""
    rng = np.random.default_rng(0)
    n = 50_000
    base = rng.pareto(1.5, n)
    impact = np.array([(base * rng.uniform(0.8, 1.2, n) * 1000).astype(np.int64) + 1 for _ in range(3)])
    shard = lexical.Lists(np.tile(np.arange(n), 3), np.repeat(np.arange(3), n), impact.ravel())
    lists = [shard.of(t) for t in range(3)]
    docs, scores, seen = lexical.best_positions(lists, 20, 1, 1)
    total = impact.sum(0)
    best = lexical.best_of(scores, docs, 20)
    assert scores[best].tolist() == sorted(total.tolist(), reverse=True)[:20]
    # last-read positions: depth p in every list until the sum of impacts at p is below the 20th score met
    depth = 0
    while True:
        depth += 1
        met = np.unique(np.concatenate([x[0][:depth] for x in lists]))
        if len(met) >= 20 and sum(int(x[1][depth]) for x in lists) < np.sort(total[met])[-20]:
            break
    assert seen < n // 100 and len(docs) <= len(met)


# -- quality: the unlabelled side is every row ------------------------------------------------------

def _numpy_totals(u):
    return lambda fn, width: sum(fn(part) for part in np.array_split(u, 7))


def test_non_negative_risk_is_its_formula():
    rng = np.random.default_rng(1)
    p, u = rng.normal(1, 1, (40, 3)), rng.normal(-0.5, 1, (90, 3))
    sigmoid = lambda z: 1 / (1 + np.exp(-z))

    def risk(w, prior):
        zp, zu = p @ w[:-1] + w[-1], u @ w[:-1] + w[-1]
        negative = sigmoid(zu).mean() - prior * sigmoid(zp).mean()
        return prior * sigmoid(-zp).mean() + max(0.0, negative), negative

    for prior, w in ((0.3, np.array([0.4, -0.2, 0.1, 0.3])), (0.95, np.array([1.0, 1.0, 1.0, -0.5]))):
        got, step = quality.non_negative_step(prior, quality.unlabelled_loss(p, w) / len(p), quality.unlabelled_loss(u, w) / len(u))
        want, negative = risk(w, prior)
        assert got == pytest.approx(want)
        if negative >= 0:
            slope = [(risk(w + e, prior)[0] - risk(w - e, prior)[0]) / 2e-6 for e in 1e-6 * np.eye(4)]
        else:  # the step goes against the negative term alone
            slope = [-(risk(w + e, prior)[1] - risk(w - e, prior)[1]) / 2e-6 for e in 1e-6 * np.eye(4)]
        assert np.allclose(step, slope, atol=1e-6)
    assert negative < 0  # both sides of the rule were met


@pytest.mark.parametrize("prior", [0.2, 0.5, 0.8])
def test_known_prior_is_found(prior):
    rng = np.random.default_rng(int(prior * 10))
    good, bad = (lambda n: rng.normal(1.5, 1, (n, quality.FEATURES))), (lambda n: rng.normal(-1.5, 1, (n, quality.FEATURES)))
    n = 40_000  # with few unlabelled rows the first scorer fits their positives as negatives, and the estimate is low
    u = np.r_[good(int(prior * n)), bad(n - int(prior * n))]
    labelled, y = np.r_[good(2000), bad(300)], np.r_[np.ones(2000), np.zeros(300)]
    model = quality.train(labelled, y, _numpy_totals(u))
    assert abs(model.prior - prior) < 0.03
    assert ((model.score(np.r_[good(500), bad(500)]) > 0.5) == np.r_[np.ones(500), np.zeros(500)]).mean() > 0.98


def test_totals_cover_every_row(spark):
    rows = np.random.default_rng(3).normal(size=(1000, quality.FEATURES))
    df = spark.createDataFrame([(r.tolist(),) for r in rows], "x array<double>").repartition(7)
    w = np.linspace(-1, 1, quality.FEATURES + 1)
    got = quality.totals_of(df)(lambda x: quality.unlabelled_loss(x, w), len(w) + 1)
    assert np.allclose(got, quality.unlabelled_loss(rows, w), rtol=1e-12)
    assert quality.totals_of(df.limit(0))(lambda x: np.array([float(len(x))]), 1)[0] == 0


# -- packing: the search itself -------------------------------------------------------------------

def plain_best_fit(n, length):
    return int(packing._built(n, np.ones(len(n)), length).max()) + 1


def fewest_bins(n, length):
    """By all subsets: the fewest bins, then the least fill of the last one."""
    best = [(0, length)] + [(len(n) + 1, 0)] * (2 ** len(n) - 1)
    for s in range(1, 2 ** len(n)):
        for i, x in enumerate(n):
            if s >> i & 1:
                bins, fill = best[s ^ 1 << i]
                best[s] = min(best[s], (bins, fill + x) if fill + x <= length else (bins + 1, x))
    return best[-1][0]


@pytest.mark.parametrize("seed", range(6))
def test_packing_reaches_the_optimum_of_few_pieces(seed):
    n = np.random.default_rng(seed).integers(3, 12, 11)
    place, crossovers = packing.evolve(n, [], seed, 20, packing.GENERATIONS, packing.POPULATION)
    assert np.bincount(place, n).max() <= 20 and crossovers > 0
    assert place.max() + 1 == fewest_bins(n.tolist(), 20) <= plain_best_fit(n, 20)


def test_packing_beats_best_fit_where_that_is_above_the_bound():
    n = np.random.default_rng(4).integers(500, 900, 3000)
    place, crossovers = packing.evolve(n, [], 1, 2048, packing.GENERATIONS, packing.POPULATION)
    assert crossovers == packing.GENERATIONS * (packing.POPULATION // 2)
    assert -(-n.sum() // 2048) <= place.max() + 1 < plain_best_fit(n, 2048)
    # an island without best-fit decreasing gains from an elite that comes to it
    alone, _ = packing.evolve(n, [], 2, 2048, 2, packing.POPULATION, plain=False)
    helped, _ = packing.evolve(n, [place], 2, 2048, 2, packing.POPULATION, plain=False)
    assert helped.max() < alone.max()


def test_packing_query_runs_crossovers_and_migration(spark):
    cut = packing.pieces(spark.read.parquet("/root/testdata/sf0.01/documents.parquet"), added=True).filter("length < 2048")
    small = cut.selectExpr("0 AS shard", "monotonically_increasing_id() AS uid", "int(length) AS length")
    epochs = [e.orderBy("island").collect() for e in packing.evolved(spark, small, 2048)]
    assert len(epochs) == packing.EPOCHS and all(len(e) == packing.ISLANDS and all(r["crossovers"] > 0 for r in e) for e in epochs)
    n = np.array([r["length"] for r in small.orderBy("uid").collect()])
    assert min(r["bins"] for r in epochs[-1]) <= plain_best_fit(n, 2048)


def test_pipeline_without_known_languages_keeps_documents(spark):
    rows = spark.createDataFrame([(1, "a text", None, "s", 6, "x"), (2, None, None, None, None, "y")], "doc_id long, text string, lang string, source string, n_chars long, extra string")
    kept = corpus_pipeline.language_id(spark, rows, "")
    assert kept.columns == corpus_pipeline.COLUMNS and sorted(r["doc_id"] for r in kept.collect()) == [1, 2]
