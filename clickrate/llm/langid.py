"""Language identification: averaged hashed subword embeddings and a linear softmax.

The bytes of a text, ASCII letters in lower case and all other ASCII characters as spaces,
give its 2-, 3- and 4-byte subwords, none reaching beyond the text's end, each hashed to one
of BUCKETS embeddings.  The mean of a text's embeddings goes through a linear softmax.  Both
are trained on the driver by stochastic gradient descent in numpy, on segments of at most
SAMPLE_DOCS labelled documents of at most SAMPLE_CHARS characters (the documented bound;
chosen by a hash of doc_id among those whose crc32(doc_id) mod 3 is not 1).

The softmax has one class more than there are languages, for texts of none of them.  Its
examples are made from the segments: letters exchanged by a random substitution (vowels for
vowels), letters shuffled, letters of another script, program text.  A score is the chance of
the likeliest language beside that class.  A fifth of the documents, and texts of no language
made from them, calibrate: the softmax's temperature (with smoothed labels, so that few or
easy rows don't drive it to an end of the grid), and the score under which a document is
rejected.  That lies halfway between the score of which a share ACCEPT of the made texts falls short
no more and the one which a share REJECT of the rightly predicted texts doesn't reach; where
these cross, the second holds, and ``false_accept`` says what share of the made texts passes.
A text of fewer than SHORT bytes, a word or two, is too short to exclude a language by: it
keeps its score and is not rejected for it.

As both maps are linear, a text's logits are the mean of one row of a small table for each
subword; that table (BUCKETS x languages, 32-bit) is all that is sent to the executors.

Defined results: null text, or no letter in it: ``und``, score 0, rejected.  No labelled row
to learn from: every text is ``und``.  Repeated rows and null ids each get a row (held_out
is false for a null id, and such rows are never learnt from).  Other columns are ignored,
whatever their names.
"""

from __future__ import annotations

import re
from dataclasses import dataclass

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from clickrate.llm.common import bounded_sample, held_out, map_rows, table

BUCKETS, WIDTH, ORDERS = 1 << 14, 16, (2, 3, 4)
SAMPLE_DOCS, SAMPLE_CHARS, EPOCHS, BATCH = 3000, 20_000, 3, 64
SEGMENTS, MADE = (300, 300, 300, 60), (300, 60)  # bytes of a document's segments, and of those no language is made from
REJECT, ACCEPT, SMOOTH = 0.001, 0.02, 0.01
SHORT = 12  # bytes, spaces around included
BLOCK = 1 << 18
_FOLD = bytes(c + 32 if 65 <= c <= 90 else c if 97 <= c <= 122 or c >= 128 else 32 for c in range(256))
_SOME = re.compile(r"[^\W\d_]")


#: Words of program text.
_CODE = b"""def return if else for while import from class self none true false int void const static public private null new string
print len range try except raise with as lambda let var function async await struct enum impl use mod fn mut match str vec
include define char unsigned double float bool switch case break continue template typename namespace using std""".split()
_VOWELS = np.frombuffer(b"aeiouy", np.uint8)
_CONSONANTS = np.frombuffer(b"bcdfghjklmnpqrstvwxz", np.uint8)


def no_language(data: bytes, rng: np.random.Generator) -> bytes:
    """A text of no language, made from folded text."""
    x, kind = np.frombuffer(data, np.uint8).copy(), rng.integers(4)
    if kind == 0:  # substitution
        swap = np.arange(256, dtype=np.uint8)
        for group in (_VOWELS, _CONSONANTS, np.arange(0x80, 0xC0, dtype=np.uint8)):
            swap[group] = rng.permutation(group)
        return swap[x].tobytes()
    if kind == 1:  # shuffle
        some = x != 32
        x[some] = rng.permutation(x[some])
        return x.tobytes()
    if kind == 2:  # another script
        lead = bytes([rng.integers(0xC3, 0xE0)]) if rng.random() < 0.7 else bytes([rng.integers(0xE1, 0xED), rng.integers(0x80, 0xC0)])
        swap = rng.permutation(np.arange(0x80, 0xC0, dtype=np.uint8))
        return b"".join(b" " if c == 32 else lead + swap[c % 64].tobytes() for c in x.tolist())[: len(data)]
    out, size = [b""], 0  # program text
    while size < len(data):
        out.append(_CODE[rng.integers(len(_CODE))] if rng.random() < 0.6 else rng.choice(np.r_[_VOWELS, _CONSONANTS], rng.integers(1, 9)).tobytes())
        size += len(out[-1]) + 1
    return b" ".join([*out, b""])


def has_letter(text: str | None) -> bool:
    return bool(text) and any(m[0].isalpha() for m in _SOME.finditer(text))


def subwords(data: bytes) -> np.ndarray:
    """Bucket numbers of all subwords, one row for each order, as long as the data (short rows end in bucket 0)."""
    x = np.frombuffer(data, np.uint8).astype(np.uint32)
    out = np.zeros((len(ORDERS), len(x)), np.uint32)
    h = x * np.uint32(0x01000193)
    for n in range(2, max(ORDERS) + 1):
        h = (h[:-1] ^ x[n - 1 :]) * np.uint32(0x01000193)
        h ^= h >> np.uint32(15)
        if n in ORDERS:
            out[ORDERS.index(n), : len(h)] = (h * np.uint32(0x9E3779B1)) >> np.uint32(18)
    return out


def _folded(text: str) -> bytes:
    return b" " + text.encode().translate(_FOLD) + b" "


@dataclass
class Model:
    languages: list[str]
    table: np.ndarray  # BUCKETS x (languages and no language)
    bias: np.ndarray
    temperature: float = 1.0
    threshold: float = 0.0
    false_accept: float = 0.0  # share of the texts of no language that pass

    def logits(self, texts: list[str]) -> np.ndarray:
        return self.folded_logits([_folded(text) for text in texts])

    def folded_logits(self, texts: list[bytes]) -> np.ndarray:
        """Blocks of many texts at once; a text longer than a block is summed over several,
        each with the bytes that subwords begun in it take from the next.  A text's logits
        do not depend on the others."""
        sums, counts = np.zeros((len(texts), len(self.bias))), np.zeros(len(texts))
        parts, starts, owners, size = [], [], [], 0

        def flush():
            at, long = np.array(starts), np.array([len(p) for p in parts])
            place = np.arange(size) - np.repeat(at, long)
            for n, rows in zip(ORDERS, subwords(b"".join(parts))):
                whole = np.clip(long - n + 1, 0, BLOCK)  # places whose subword ends in the text
                values = self.table[rows]
                values[place >= np.repeat(whole, long)] = 0
                np.add.at(sums, owners, np.add.reduceat(values, at, axis=0))
                np.add.at(counts, owners, whole)

        for i, data in enumerate(texts):
            for k in range(0, len(data), BLOCK):
                parts.append(data[k : k + BLOCK + max(ORDERS) - 1])
                starts.append(size)
                owners.append(i)
                size += len(parts[-1])
                if size >= BLOCK:
                    flush()
                    parts, starts, owners, size = [], [], [], 0
        if size:
            flush()
        return sums / np.maximum(counts, 1)[:, None] + self.bias

    def probabilities(self, texts: list[str]) -> np.ndarray:
        """Of each language (with that of no language, they add up to 1)."""
        return _softmax(self.logits(texts) / self.temperature)[:, : len(self.languages)]


def _softmax(z: np.ndarray) -> np.ndarray:
    e = np.exp(z - z.max(axis=1, keepdims=True))
    return e / e.sum(axis=1, keepdims=True)


def train(rows: list[tuple[str, str]], seed: int = 7) -> Model | None:
    """From (text, language) rows; None if there are none with a letter."""
    rows = [r for r in rows if has_letter(r[0])]
    if not rows:
        return None
    rng = np.random.default_rng(seed)
    languages = sorted({lang for _, lang in rows})
    number = {lang: i for i, lang in enumerate(languages)}
    order = rng.permutation(len(rows))
    held = [rows[i] for i in order[: len(rows) // 5]] or rows
    none = len(languages)
    segments, y = [], []

    def add(part: bytes, label: int) -> None:
        segments.append(np.concatenate([x[: max(0, len(part) - n + 1)] for n, x in zip(ORDERS, subwords(part))]).astype(np.int64))
        y.append(label)

    def cut(data: bytes, size: int) -> bytes:
        k = int(rng.integers(0, max(1, len(data) - size)))
        return data[k : k + size]

    for i in order[len(rows) // 5 :]:
        data = _folded(rows[i][0])
        for size in SEGMENTS:
            add(cut(data, size), number[rows[i][1]])
        for size in MADE:
            add(no_language(cut(data, size), rng), none)
    y = np.array(y)
    embed = rng.normal(0, 0.1, (BUCKETS, WIDTH)).astype(np.float32)
    out, bias = rng.normal(0, 0.1, (WIDTH, none + 1)).astype(np.float32), np.zeros(none + 1, np.float32)
    steps, done = EPOCHS * -(-len(segments) // BATCH), 0
    for _ in range(EPOCHS):
        shuffled = rng.permutation(len(segments))
        for at in range(0, len(shuffled), BATCH):
            batch = shuffled[at : at + BATCH]
            counts = np.zeros((len(batch), BUCKETS), np.float32)
            for j, i in enumerate(batch):
                counts[j] = np.bincount(segments[i], minlength=BUCKETS) / len(segments[i])
            mean = counts @ embed
            p = _softmax(mean @ out + bias)
            p[np.arange(len(batch)), y[batch]] -= 1
            p /= len(batch)
            rate = np.float32(20 * (1 - done / steps))
            back = p @ out.T
            out -= rate * 0.1 * (mean.T @ p)
            bias -= rate * 0.01 * p.sum(axis=0)
            embed -= rate * 5 * (counts.T @ back)
            done += 1
    model = Model(languages, embed @ out, bias.astype(float))
    known, made = [_folded(t) for t, _ in held], []
    for data in known:
        made += [no_language(cut(data, size), rng) for size in MADE]
    z, truth = model.folded_logits(known + made), np.array([number[lang] for _, lang in held] + [none] * len(made))

    def loss(t: float) -> float:
        p = np.log(_softmax(z / t) + 1e-12)
        return -((1 - SMOOTH) * p[np.arange(len(z)), truth] + SMOOTH * p.mean(axis=1)).mean()

    model.temperature = float(min(np.geomspace(0.05, 10, 60), key=loss))
    p = _softmax(z / model.temperature)[:, :none]
    best, strange = p.max(axis=1), truth == none
    right = best[~strange & (p.argmax(axis=1) == truth)]
    least, most = np.quantile(right, REJECT) if len(right) else 0.0, np.quantile(best[strange], 1 - ACCEPT)
    model.threshold = float(min(least, (least + most) / 2))
    model.false_accept = float((best[strange] >= model.threshold).mean())
    return model


def learn(docs: DataFrame, rows: int = SAMPLE_DOCS) -> Model | None:
    known = docs.filter(F.col("lang").isNotNull() & (held_out(F.col("doc_id"), 3) != 1) & (F.length("text") <= SAMPLE_CHARS))
    return train([(r["text"], r["lang"]) for r in bounded_sample(known.select("doc_id", "text", "lang"), "doc_id", rows).collect()])


def identify(spark: SparkSession, docs: DataFrame, model: Model | None, carry: list[str] = ("doc_id",)) -> DataFrame:
    """The columns ``carry`` with lang_pred, score, rejected."""
    sent = spark.sparkContext.broadcast(model)

    def make():
        m = sent.value

        def fn(cols):
            texts = cols["text"]
            pred, score = ["und"] * len(texts), [0.0] * len(texts)
            some = [i for i, t in enumerate(texts) if m and has_letter(t)]
            if some:
                p = m.probabilities([texts[i] for i in some])
                for i, k, s in zip(some, p.argmax(axis=1).tolist(), p.max(axis=1).tolist()):
                    pred[i], score[i] = m.languages[k], min(1.0, s)
            return {"lang_pred": pred, "score": score, "rejected": [x == "und" or s < m.threshold and len(_folded(t)) >= SHORT for x, s, t in zip(pred, score, texts)]}

        return fn

    return map_rows(docs, make, "lang_pred string, score double, rejected boolean", ["text"], list(carry))


def op7_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All whole texts of ``documents``."""
    docs = table(spark, sf_dir, "documents")
    found = identify(spark, docs, learn(docs))
    return found.select("doc_id", F.coalesce(held_out(F.col("doc_id"), 3) == 1, F.lit(False)).alias("held_out"), "lang_pred", "score", "rejected")
