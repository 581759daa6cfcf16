"""Secret scans: three fixed patterns, and a battery of randomness tests for all else.

Base spans, leftmost and non-overlapping per kind: assignments to names like password or
token with a value of 8 or more characters, access keys (AKIA...) of 16 or more, runs of 32
or more lower-case hex digits.

Candidates for the battery are runs of 20 or more characters of ``[A-Za-z0-9+/_-]`` with a
digit and a letter that no base span touches.  An ``=`` ends a run and belongs to it only as
padding, where no further character of a run follows; so name and value of ``NAME=value`` are
tested each on its own.  A run that holds both ``_`` or ``-`` and ``+`` or ``/`` fits no
alphabet: its parts between the ones and its parts between the others are the candidates, and
found parts that overlap are reported as one.  The smallest fitting alphabet (hex, base 32,
36, 62, 64) is inferred, and the symbols are tested for what a random string must show:
uniform use of the alphabet (chi-squared), no trend of runs about the alphabet's middle
(Wald-Wolfowitz), no correlation of neighbours (lag 1).  A candidate that fails one of them
(Bonferroni, PASS) is no random string and counts no further.  The rest is held against what
words and identifiers would give: a Markov model of them (kinds of neighbouring characters,
and letter pairs of program names and of prose in nine languages), mixed with FLAT of uniform
characters.  The chance of the string under that model over its chance as a random string in
one of the alphabets bounds the p-value of being text (Markov's inequality).  Those p-values,
weighted by length, go through Benjamini-Hochberg at rate FDR within each document, among the
candidates that passed, so its decision depends on that document alone.

Recall falls with the length (README); a string without a digit is no candidate.

Defined results: null text is empty: no spans.  Repeated rows and null ids each get a row.
Other columns are ignored, whatever their names.
"""

from __future__ import annotations

import hashlib
import math
import re

import numpy as np
from pyspark.sql import DataFrame, SparkSession

from clickrate.llm.common import map_rows, table

# The contract's patterns and kinds.
KINDS = ("assign", "access", "hex", "random")
_NAMES = (b"password", b"passwd", b"secret", b"token", b"api_key", b"apikey")
_ASSIGN = re.compile(r"""(?ai:(password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""")
_ACCESS = re.compile(r"AKIA[A-Z0-9]{12,}")
_HEX = re.compile(r"[0-9a-f]{32,}")

_LONG = re.compile(r"(?<![A-Za-z0-9+/_-])[A-Za-z0-9+/_-]{16,}(?:=+(?![A-Za-z0-9+/_=-]))?")
_PARTS = (re.compile(r"[A-Za-z0-9_-]+=*"), re.compile(r"[A-Za-z0-9+/]+=*"))
LEAST, PASS, FDR = 20, 0.003, 0.01
_DIGITS, _LOWER, _UPPER = "0123456789", "abcdefghijklmnopqrstuvwxyz", "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
ENCODINGS = [(name, {c: i for i, c in enumerate(symbols)}) for name, symbols in (
    ("hex", _DIGITS + "abcdef"), ("hex", _DIGITS + "ABCDEF"), ("base32", _UPPER + "234567"), ("base36", _DIGITS + _LOWER),
    ("base36", _DIGITS + _UPPER), ("base62", _DIGITS + _UPPER + _LOWER), ("base64", _UPPER + _LOWER + _DIGITS + "+/"),
    ("base64url", _UPPER + _LOWER + _DIGITS + "-_"))]

#: -4 ln of the chance of each letter a-z after each letter a-z and (last row) at a word's start: A = 0, ..., Z = 25, a = 26, ...
_PAIRS = (
    "RNLMYUOYOaSIMJcNbIKHRRVSQYIPNRISVXKNZHTTKRYMMRKZZZMYIWQTJVYJNbLMTVGUaOQJNXZbTdJSSNFPTYHXaPUTKVYOMONWXSTcNULJQPQWRaVMOJVPRHILWRTMTY"
    "KURQKJSYGaaLTSIUZLONLZXaRbMUSTFTOLKdYNQLMSZJLQMVYZUVGWXSFWYXJdXQRSIWdNQLOYYaRbOQLNNONcYYVLMFKPYOKKZPdSeOJXPOGUUYNXORTSIPcSJTIQUZWW"
    "LTTQERPWJWUMUOLSYQJOQSObRbJVTOGRVYHbWKVUJTcVMMNUYZMZGOXTFWWZJeWQMSKJdWNRNYZZTbKVLJJPIWMYRSVQLRZVKHPQYYUYRPMLTRQZRZRLLGOMbHNMLQOUaZ"
    "HXTSHVXQMdWJWUJMZIOLOXYbMaQYVRTTZVVaRLTPWTUPNRBXTZZbIVPOGTPYJdRRNPJSaNLLPSVcQbNXNUHTTNJbPQSTMMTVKGLVUZQbJWQSGTYLHdYRSVLScJMNOXUXNV"
    "NMOPLPQbNaZKKHSLdJKJXYbWaXFWUVDWWYIdbURTMYdURUWXYUZbHUSPIUWKHbURTLKXeKLTWWQUZbMRKPJOXRJaaPOURIaSPHVRYNQWOROOMRRWNcWMMMOGZQJJWSQTQR"
    "JaWSDTYUIbZURVMTbXSURcUWQMLNKLMMPPLUSNMNOLULJLOQPTWV"
)
#: Chances that a lower-case letter, an upper-case letter, a digit, one of +/_- follow each of these and stand first.
_KINDS = np.array([[0.86, 0.04, 0.04, 0.06], [0.36, 0.50, 0.06, 0.08], [0.10, 0.06, 0.62, 0.22], [0.60, 0.15, 0.20, 0.05], [0.50, 0.20, 0.15, 0.15]])
FLAT = 0.07


def _text_model() -> np.ndarray:
    """ln of the chance of each of the 66 characters (columns: a-z, A-Z, 0-9, +/_-) after each of them and, last row, as the first."""
    code = np.frombuffer(_PAIRS.encode(), np.uint8).reshape(27, 26)
    pairs = np.exp((65.0 - np.where(code > 96, code - 6, code)) / 4)
    pairs /= pairs.sum(axis=1, keepdims=True)
    kind = np.repeat([0, 1, 2, 3, 4], [26, 26, 10, 4, 1])
    out = np.zeros((67, 66))
    for row in range(67):
        for to in (0, 1):
            goes_on = kind[row] == to or (kind[row], to) == (1, 0)
            out[row, 26 * to : 26 * to + 26] = pairs[row % 26 if goes_on else 26] * _KINDS[kind[row], to]
        out[row, 52:62], out[row, 62:] = _KINDS[kind[row], 2] / 10, _KINDS[kind[row], 3] / 4
    return np.log((1 - FLAT) * out + FLAT / 66)


_TEXT = _text_model()
_PLACE = np.zeros(128, np.intp)
_PLACE[np.frombuffer((_LOWER + _UPPER + _DIGITS + "+/_-").encode(), np.uint8)] = np.arange(66)


def _upper_tail(z: float) -> float:
    return 0.5 * math.erfc(z / math.sqrt(2))


def _chi2_tail(x: float, df: int) -> float:
    """Wilson-Hilferty."""
    v = 2 / (9 * df)
    return _upper_tail(((max(x, 0) / df) ** (1 / 3) - (1 - v)) / math.sqrt(v))


def battery(token: str) -> tuple[str, float, float] | None:
    """(encoding, least p-value of the three tests for randomness, p-value of being text); None: no encoding fits."""
    body = token.rstrip("=")
    n, chars = len(body), set(body)
    name, index = next((e for e in ENCODINGS if chars <= e[1].keys()), (None, None))
    if name is None or n < LEAST or not chars & set(_DIGITS) or not chars - set(_DIGITS):
        return None
    k = len(index)
    x = np.array([index[c] for c in body])
    cells = min(k, max(4, n // 5))  # five expected in a cell
    edges = (np.arange(k) * cells) // k
    expected = n * np.bincount(edges, minlength=cells) / k
    uniform = _chi2_tail(float(((np.bincount(edges[x], minlength=cells) - expected) ** 2 / expected).sum()), cells - 1)
    high = x >= k / 2
    n1, n0 = int(high.sum()), int(n - high.sum())
    mean = 1 + 2 * n1 * n0 / n
    var = (mean - 1) * (mean - 2) / (n - 1)
    runs = 2 * _upper_tail(abs(1 + int((high[1:] != high[:-1]).sum()) - mean) / math.sqrt(var)) if var > 0 else 0.0
    y = x - x.mean()
    spread = float((y * y).sum())
    serial = 2 * _upper_tail(abs(float((y[1:] * y[:-1]).sum()) / spread + 1 / n) * math.sqrt(n)) if spread else 0.0
    at = _PLACE[np.frombuffer(body.encode(), np.uint8)]
    text = float(_TEXT[np.r_[66, at[:-1]], at].sum()) + n * math.log(k) + math.log(len(ENCODINGS))
    return name, min(uniform, runs, serial), math.exp(min(0.0, text))


def discoveries(tokens: list[str]) -> list[bool]:
    """Which candidates of a document are random strings: weighted Benjamini-Hochberg."""
    tested = [(i, r[2], len(t)) for i, t in enumerate(tokens) if (r := battery(t)) and 3 * r[1] >= PASS]
    found = [False] * len(tokens)
    mean = sum(n for _, _, n in tested) / max(1, len(tested))
    ranked = sorted((min(1.0, p * mean / n), i) for i, p, n in tested)
    last = max((k for k, (p, _) in enumerate(ranked, 1) if p <= FDR * k / len(ranked)), default=0)
    for _, i in ranked[:last]:
        found[i] = True
    return found


def candidates(text: str, a: int, b: int) -> list[tuple[int, int]]:
    """The run itself, or its parts where it holds symbols that no alphabet has together."""
    run = text[a:b]
    if not (("_" in run or "-" in run) and ("+" in run or "/" in run)):
        return [(a, b)]
    return sorted({(a + m.start(), a + m.end()) for part in _PARTS for m in part.finditer(run) if m.end() - m.start() >= LEAST})


def joined(spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """The spans by start, those that overlap as one."""
    out: list[tuple[int, int]] = []
    for a, b in sorted(spans):
        if out and a < out[-1][1]:
            out[-1] = (out[-1][0], max(b, out[-1][1]))
        else:
            out.append((a, b))
    return out


def spans_of(text: str | None) -> list[tuple[int, int, str]]:
    """(start, end, kind) of every secret, by start and then kind as listed."""
    text = text or ""
    found, low = [], text.encode().lower()
    if any(x in low for x in _NAMES):
        found += [(m.start(), m.end(), "assign") for m in _ASSIGN.finditer(text) if len(m[2]) >= 8]
    long = [m.span() for m in _LONG.finditer(text)]
    if long:
        found += [(*m.span(), "access") for m in _ACCESS.finditer(text)] + [(*m.span(), "hex") for m in _HEX.finditer(text)]
        runs = [candidates(text, a, b) for a, b in long if b - a >= LEAST and not any(x < b and a < y for x, y, _ in found)]
        random = iter(discoveries([text[a:b] for run in runs for a, b in run]))
        found += [(a, b, "random") for run in runs for a, b in joined([s for s in run if next(random)])]
    return sorted(found, key=lambda s: (s[0], KINDS.index(s[2])))


def scan(docs: DataFrame, carry: list[str] = ("doc_id",)) -> DataFrame:
    """The columns ``carry`` with kinds, starts and ends of the spans (code points, end exclusive)."""

    def make():
        def fn(cols):
            spans = [spans_of(t) for t in cols["text"]]
            return {"kinds": [[s[2] for s in x] for x in spans], "starts": [[s[0] for s in x] for x in spans], "ends": [[s[1] for s in x] for x in spans]}

        return fn

    return map_rows(docs, make, "kinds array<string>, starts array<long>, ends array<long>", ["text"], list(carry))


def redacted(docs: DataFrame, mark: str = "[SECRET]") -> DataFrame:
    """The documents with every secret replaced by ``mark`` (spans that touch as one) and n_chars anew where it changed."""

    def make():
        def fn(cols):
            texts, sizes = [], []
            for text, size in zip(cols["text"], cols["n_chars"]):
                out, at = [], 0
                for a, b, _ in spans_of(text):
                    if a >= at:
                        out += [text[at:a], mark]
                    at = max(at, b)
                texts.append("".join([*out, text[at:]]) if out else text)
                sizes.append(len(texts[-1]) if out else size)
            return {"text": texts, "n_chars": sizes}

        return fn

    rest = [c for c in docs.columns if c not in ("text", "n_chars")]
    return map_rows(docs, make, "text string, n_chars long", ["text", "n_chars"], rest).select(docs.columns)


def op2_secret_scans(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All whole texts of ``documents``; the digest columns come from the scan's spans."""

    def make():
        def fn(cols):
            rows = [[(f"{k}:{a}:{b}", k) for k, a, b in zip(*x)] for x in zip(cols["kinds"], cols["starts"], cols["ends"])]
            return {f"n_{kind}": [sum(k == kind for _, k in r) for r in rows] for kind in KINDS[:3]} | {
                "base_sha256": [hashlib.sha256(",".join(s for s, k in r if k in KINDS[:3]).encode()).hexdigest() for r in rows],
                "spans": [",".join(s for s, _ in r) for r in rows]}

        return fn

    found = scan(table(spark, sf_dir, "documents"))
    return map_rows(found, make, "n_assign long, n_access long, n_hex long, base_sha256 string, spans string", ["kinds", "starts", "ends"], ["doc_id"])
