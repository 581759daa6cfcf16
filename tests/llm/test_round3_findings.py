"""Operators 7 and 8: Wu-Manber against brute force, memory of a block, long items; languages that were not learned."""

import random
import tracemalloc

import numpy as np
import pyarrow.parquet as pq
import pytest

from clickrate.llm import decontam, langid


def brute_windows(items, window):
    found = {}
    for item, text in items:
        w = decontam.words_of(text)
        m = min(window, len(w))
        for i in range(len(w) - m + 1 if w else 0):
            found.setdefault(m, {}).setdefault(tuple(w[i : i + m]), set()).add(str(item))
    return found


@pytest.mark.parametrize("seed", range(4))
def test_wu_manber_against_brute_force(seed):
    rng = random.Random(seed)
    text = lambda n, k: " ".join(rng.choices([f"w{i}" for i in range(k)], k=n))
    items = [(i, text(rng.choice((1, 2, 3, 5, 30)), 3)) for i in range(40)] + [(90, None), (91, " "), (92, "w0 " * 50), (92, "w0 " * 50)]
    tables, want = decontam.Tables(items, 5), brute_windows(items, 5)
    for n in (0, 1, 2, 4, 200):
        words = decontam.words_of(text(n, 4))
        found = {(a, b): x for a, b, x in tables.find(words)}
        assert found == {(i, i + m): pats[tuple(words[i : i + m])] for m, pats in want.items() for i in range(len(words) - m + 1) if tuple(words[i : i + m]) in pats}


def test_tables_of_a_block_have_a_bound():
    """A block of which nearly every word is another one, the worst case of the dictionary."""
    rng = random.Random(1)
    text = " ".join("".join(rng.choices("abcdefghijklmnopqrstuvwxyz", k=6)) for _ in range(decontam.BLOCK_CHARS // 28))
    tracemalloc.start()
    tables = decontam.Tables([(1, text)], 13)
    held, most = tracemalloc.get_traced_memory()
    tracemalloc.stop()
    assert tables.searches and held < 40 * len(text) and most < 80 * len(text)


def test_long_items_in_pieces_and_blocks(spark, monkeypatch):
    words = [f"w{i % 37}x{i % 11}" for i in range(700)]
    bench = spark.createDataFrame([(1, " ".join(words)), (2, " ".join(words[:5])), (3, None)], "item_id long, text string")
    docs = spark.createDataFrame([(k, " ".join(["no"] * 9 + words[k : k + 60])) for k in range(0, 600, 43)] + [(None, None), (1, "")], "doc_id long, text string")
    cols = ["doc_id", "n_words", "n_hit", "n_items", "items_sha256", "contaminated"]
    rows = lambda: sorted(decontam.contamination(spark, docs, bench).select(cols).collect(), key=str)
    whole = rows()
    assert sum(r["n_hit"] == 60 for r in whole) == 14
    monkeypatch.setattr(decontam, "PIECE_WORDS", 20)
    monkeypatch.setattr(decontam, "BLOCK_CHARS", 2000)
    assert rows() == whole


def test_an_empty_benchmark(spark):
    docs = spark.createDataFrame([(1, "a b c"), (None, None)], "doc_id long, text string")
    got = decontam.contamination(spark, docs, spark.createDataFrame([], "item_id long, text string")).collect()
    assert sorted((r["n_words"], r["n_hit"], r["contaminated"]) for r in got) == [(0, 0, False), (3, 0, False)]


#: The first sentences of a public declaration in languages that the tables don't have, keys struck at random, program text.
STRANGE = [
    'Kaikki ihmiset syntyvät vapaina ja tasavertaisina arvoltaan ja oikeuksiltaan. Heille on annettu järki ja omatunto',
    'Bütün insanlar hür, haysiyet ve haklar bakımından eşit doğarlar. Akıl ve vicdana sahiptirler ve birbirlerine karşı',
    'Wszyscy ludzie rodzą się wolni i równi pod względem swej godności i swych praw. Są oni obdarzeni rozumem i sumieniem',
    'Watu wote wamezaliwa huru, hadhi na haki zao ni sawa. Wote wamejaliwa akili na dhamiri, hivyo yapasa watendeane kindugu',
    'Όλοι οι άνθρωποι γεννιούνται ελεύθεροι και ίσοι στην αξιοπρέπεια και τα δικαιώματα. Είναι προικισμένοι με λογική',
    'Minden emberi lény szabadon születik és egyenlő méltósága és joga van. Az emberek, ésszel és lelkiismerettel bírván',
    'Все люди рождаются свободными и равными в своем достоинстве и правах. Они наделены разумом и совестью и должны',
    'すべての人間は、生まれながらにして自由であり、かつ、尊厳と権利とについて平等である。人間は、理性と良心とを授けられており',
    "Genir pawb yn rhydd ac yn gydradd â'i gilydd mewn urddas a hawliau. Fe'u cynysgaeddir â rheswm a chydwybod",
    'Tất cả mọi người sinh ra đều được tự do và bình đẳng về nhân phẩm và quyền. Mọi con người đều được tạo hoá ban cho',
    'Semua orang dilahirkan merdeka dan mempunyai martabat dan hak-hak yang sama. Mereka dikaruniai akal dan hati nurani',
    'Gizon-emakume guztiak aske jaiotzen dira, duintasun eta eskubide berberak dituztela; eta ezaguera eta kontzientzia',
    'Všichni lidé rodí se svobodní a sobě rovní co do důstojnosti a práv. Jsou nadáni rozumem a svědomím a mají spolu jednat',
    'asdkjh qwlekj zxcmnb poiuqwe lkjasd mnzxcv qpwoei rutyal skdjfh gbvnmc xzaqwe sdfwer tyughj bnmkop',
    'def load(path, n=10): return [int(x) for x in open(path).read().split()][:n] if os.path.exists(path) else None',
    '#include <stdio.h> int main(void) { char *buf = malloc(256); for (int i = 0; i < 10; i++) printf(buf, i); return 0; }',
    'Alle mensen worden vrij en gelijk in waardigheid en rechten geboren. Zij zijn begiftigd met verstand en geweten',
    'Todos os seres humanos nascem livres e iguais em dignidade e em direitos. Dotados de razão e de consciência, devem agir',
    'Tutti gli esseri umani nascono liberi ed eguali in dignità e diritti. Essi sono dotati di ragione e di coscienza',
    'Alla människor är födda fria och lika i värde och rättigheter. De är utrustade med förnuft och samvete',
    'Kõik inimesed sünnivad vabadena ja võrdsetena oma väärikuselt ja õigustelt. Neile on antud mõistus ja südametunnistus',
    'Visi žmonės gimsta laisvi ir lygūs savo orumu ir teisėmis. Jiems suteiktas protas ir sąžinė',
    'Toate ființele umane se nasc libere și egale în demnitate și în drepturi. Ele sunt înzestrate cu rațiune și conștiință',
    '모든 인간은 태어날 때부터 자유로우며 그 존엄과 권리에 있어 동등하다. 인간은 천부적으로 이성과 양심을',
]


@pytest.fixture(scope="module")
def labelled():
    rows = pq.read_table("/root/testdata/sf0.1/documents.parquet", columns=["text", "lang"]).to_pylist()
    rows = [(r["text"], r["lang"]) for r in rows if r["lang"] and r["text"] and len(r["text"]) <= langid.SAMPLE_CHARS]
    return [rows[i] for i in np.random.default_rng(0).permutation(len(rows))]


@pytest.mark.parametrize("sample", range(3))
def test_texts_of_no_learned_language_are_rejected(labelled, sample):
    model = langid.train(labelled[2500 * sample : 2500 * sample + 2500])
    assert 0.3 < model.temperature < 3 and model.false_accept <= 0.05
    score = model.probabilities(STRANGE).max(axis=1)
    assert (score >= model.threshold).mean() <= 0.05
    rest = [r for r in labelled[:2500 * sample] + labelled[2500 * sample + 2500 :] if len(langid._folded(r[0])) >= langid.SHORT]
    p = model.probabilities([t for t, _ in rest])
    assert (p.max(axis=1) < model.threshold).mean() <= 0.002
    assert np.mean([model.languages[k] == lang for k, (_, lang) in zip(p.argmax(axis=1), rest)]) > 0.995


def test_few_rows_do_not_drive_the_temperature(labelled):
    for n in (10, 40, 200):
        assert 0.1 < langid.train(labelled[:n]).temperature < 9


def test_short_and_letterless_texts(spark, labelled):
    docs = spark.createDataFrame([(1, "Xq."), (2, None), (3, "12 34"), (4, STRANGE[0]), (4, STRANGE[0]), (None, labelled[0][0])], "doc_id long, text string")
    got = langid.identify(spark, docs, langid.train(labelled[:2500])).collect()
    said = sorted((r["doc_id"] or 0, r["rejected"], r["lang_pred"] == "und") for r in got)
    assert said == [(0, False, False), (1, False, False), (2, True, True), (3, True, True), (4, True, False), (4, True, False)]
