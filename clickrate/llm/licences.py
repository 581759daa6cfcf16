"""Licence scans: a trained paragraph classifier, confirmed against templates.

A text's paragraphs are its lines and, where it has blank lines, the blocks between them.
Words are ASCII letters and digits in lower case.  A paragraph's 1- and 2-word n-grams are
the sparse features of a multinomial logistic regression over the licence families and the
class ``unknown``, trained by stochastic gradient descent in numpy: on the templates below
(cut, with words dropped and foreign words put in) and, for the unknown class, on the UNKNOWN
lines with the smallest hashes among all distinct lines of all documents (long lines in
pieces of PIECE characters) that share little with any template.  The temperature and the
least probability of being licensed are calibrated by a first model, from which every fifth
template of a family and every fifth line are kept back whole; the second model learns from all.

A paragraph has a family if it is licensed with that probability, the family has SHARE of it,
and a template confirms it by alignment: of a notice (at most NOTICE words) all its words but
function words and words for the work itself must stand in the paragraph, in order and
near each other (and of a heading, at most HEADING words, the paragraph has
few other words); of a longer template CONFIRM of these words, or COVERED of the paragraph's own
must stand in the template in order.  All confirmed families are reported, one entry each
("MIT OR Apache-2.0"), but for those whose aligned words a template of any other family has too
and fits better (GPL wording within LGPL wording).  The least probability is the one at which at most a share
ALARMS of the kept back lines is reported, LIKELIER or more.

Only n-grams that training has seen have weights; the vocabulary (bounded by the sample)
and its weights are all that is sent to the executors.

Defined results: null or empty text: no paragraphs, no families.  Repeated rows and null
ids each get a row.  Other columns are ignored, whatever their names.
"""

from __future__ import annotations

import re
from dataclasses import dataclass, field
from difflib import SequenceMatcher

import numpy as np
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from clickrate.llm.common import map_rows, table

UNKNOWN, PIECE, COPIES, EPOCHS, LEAST_WORDS = 3000, 600, 40, 4, 2
CONFIRM, COVERED, SHARE, NOTICE, HEADING, ALARMS, LIKELIER = 0.6, 0.8, 0.1, 14, 4, 0.01, 0.5

# Public licence wording, by family.
TEMPLATES = {
    "MIT": [
        "Released under the MIT License.", "This project is licensed under the terms of the MIT license.", "SPDX-License-Identifier: MIT",
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files, to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software",
        "The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software.",
        'MIT License',
        'The MIT License (MIT)',
        'Licensed under the MIT license.',
        'Distributed under the MIT software license.',
        'The software is provided "as is", without warranty of any kind, express or implied, including but not limited to the warranties of merchantability, fitness for a particular purpose and noninfringement. In no event shall the authors or copyright holders be liable for any claim, damages or other liability, whether in an action of contract, tort or otherwise, arising from, out of or in connection with the software or the use or other dealings in the software.',
    ],
    "Apache-2.0": [
        "Licensed under the Apache License, Version 2.0.", "SPDX-License-Identifier: Apache-2.0",
        "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in compliance with the License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0",
        "Unless required by applicable law or agreed to in writing, software distributed under the License is distributed on an \"AS IS\" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied.",
        'Apache License',
        'Apache License, Version 2.0',
        'Apache License Version 2.0, January 2004',
        'This project is licensed under the Apache 2.0 license.',
        'See the License for the specific language governing permissions and limitations under the License.',
        'Grant of Copyright License. Subject to the terms and conditions of this License, each Contributor hereby grants to You a perpetual, worldwide, non-exclusive, no-charge, royalty-free, irrevocable copyright license to reproduce, prepare Derivative Works of, publicly display, publicly perform, sublicense, and distribute the Work and such Derivative Works in Source or Object form.',
        'Grant of Patent License. Subject to the terms and conditions of this License, each Contributor hereby grants to You a perpetual, worldwide, non-exclusive, no-charge, royalty-free, irrevocable patent license to make, have made, use, offer to sell, sell, import, and otherwise transfer the Work',
    ],
    "GPL": [
        "This work is licensed under the GNU General Public License, version 3.", "SPDX-License-Identifier: GPL-3.0-or-later", "SPDX-License-Identifier: GPL-2.0-only",
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version.",
        "You should have received a copy of the GNU General Public License along with this program.",
        'GNU General Public License',
        'Released under the GPL version 2.',
        'Licensed under the GPLv3.',
        'This program is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; without even the implied warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE. See the GNU General Public License for more details.',
        'The GNU General Public License is a free, copyleft license for software and other kinds of works.',
        'The licenses for most software and other practical works are designed to take away your freedom to share and change the works. By contrast, the GNU General Public License is intended to guarantee your freedom to share and change all versions of a program',
    ],
    "LGPL": [
        "This library is licensed under the GNU Lesser General Public License, version 2.1.", "SPDX-License-Identifier: LGPL-2.1-or-later",
        "This library is free software; you can redistribute it and/or modify it under the terms of the GNU Lesser General Public License as published by the Free Software Foundation",
        'GNU Lesser General Public License',
        'You should have received a copy of the GNU Lesser General Public License along with this library.',
        'This library is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; without even the implied warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE. See the GNU Lesser General Public License for more details.',
    ],
    "AGPL": [
        "This work is licensed under the GNU Affero General Public License, version 3.", "SPDX-License-Identifier: AGPL-3.0-only",
        "You should have received a copy of the GNU Affero General Public License along with this program.",
        'GNU Affero General Public License',
        'it under the terms of the GNU Affero General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version.',
    ],
    "BSD": [
        "Licensed under the 3-Clause BSD License.", "SPDX-License-Identifier: BSD-3-Clause", "SPDX-License-Identifier: BSD-2-Clause", "Use of this source code is governed by a BSD-style license that can be found in the LICENSE file.",
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met",
        "Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer.",
        'BSD License',
        'BSD 3-Clause License',
        'BSD 2-Clause License',
        'Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer in the documentation and/or other materials provided with the distribution.',
        'Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from this software without specific prior written permission.',
        'This software is provided by the copyright holders and contributors "as is" and any express or implied warranties, including, but not limited to, the implied warranties of merchantability and fitness for a particular purpose are disclaimed. In no event shall the copyright holder or contributors be liable for any direct, indirect, incidental, special, exemplary, or consequential damages',
    ],
    "MPL-2.0": [
        "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0.", "SPDX-License-Identifier: MPL-2.0", "Licensed under the Mozilla Public License, version 2.0.",
    ],
    "ISC": [
        "Licensed under the ISC License.", "SPDX-License-Identifier: ISC",
        "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the above copyright notice and this permission notice appear in all copies.",
    ],
    "CC-BY": [
        "Licensed under CC BY 4.0.", "This work is licensed under a Creative Commons Attribution 4.0 International License.", "SPDX-License-Identifier: CC-BY-4.0",
    ],
    "CC-BY-SA": [
        "Licensed under CC BY-SA 4.0.", "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License.", "SPDX-License-Identifier: CC-BY-SA-4.0",
    ],
    "CC-BY-NC": [
        "Licensed under CC BY-NC 4.0.", "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License.", "SPDX-License-Identifier: CC-BY-NC-4.0",
    ],
    "EPL": [
        "Eclipse Public License", "SPDX-License-Identifier: EPL-2.0", "Licensed under the Eclipse Public License, version 2.0.",
        "This program and the accompanying materials are made available under the terms of the Eclipse Public License which accompanies this distribution",
    ],
    "zlib": [
        "zlib License", "SPDX-License-Identifier: Zlib", "Licensed under the zlib license.",
        "This software is provided 'as-is', without any express or implied warranty. In no event will the authors be held liable for any damages arising from the use of this software.",
        "Permission is granted to anyone to use this software for any purpose, including commercial applications, and to alter it and redistribute it freely, subject to the following restrictions",
        "The origin of this software must not be misrepresented; you must not claim that you wrote the original software.",
        "Altered source versions must be plainly marked as such, and must not be misrepresented as being the original software.",
    ],
    "public-domain": [
        "This is free and unencumbered software released into the public domain.", "To the extent possible under law, the author has waived all copyright and related rights to this work.", "SPDX-License-Identifier: CC0-1.0", "SPDX-License-Identifier: Unlicense",
    ],
}
#: Sentences about licences that grant none, for the unknown class.
DISTRACTORS = [
    "He renewed his driving license at the county office last week.", "The restaurant lost its liquor license after two complaints.", "All rights reserved by the publisher of this newspaper.",
    "The software is sold under a commercial agreement; ask our sales staff for terms.", "Version 3 of the report was released to the public on Monday.", "She studied at MIT and later taught there.",
    "The general public is invited to the library for free.", "A copy of the letter was distributed to every person in the office.", "The Apache helicopter landed near the foundation's office.",
    "This project is discussed under the terms of the old contract.", "You should have received a copy of the programme along with this letter.", "The club gave him a fishing license for version 2 of the boat.",
    "The general public has no access to the archive.", "The terms of the loan are subject to the following conditions.", "No warranty is given for used cars of any kind.",
]
_FOLD = bytes(c + 32 if 65 <= c <= 90 else c if 48 <= c <= 57 or 97 <= c <= 122 or c >= 128 else 32 for c in range(256))
_BLANK = re.compile(r"\n[ \t\r]*\n")


def words_of(paragraph: str) -> list[bytes]:
    return paragraph.encode().translate(_FOLD).split()


def paragraphs(text: str | None) -> list[tuple[int, int]]:
    """(start, end) of the lines with characters, and of the blocks of several lines."""
    out, at = [], 0
    for line in (text or "").split("\n"):
        if line.strip():
            out.append((at, at + len(line)))
        at += len(line) + 1
    at = 0
    for cut in [*_BLANK.finditer(text or ""), None]:
        end = cut.start() if cut else len(text or "")
        if "\n" in (block := (text or "")[at:end]).strip("\n"):
            out.append((at + len(block) - len(block.lstrip("\n")), end))
        at = cut.end() if cut else end
    return out


def _pairs(words: list[bytes]) -> set:
    return set(zip(words, words[1:]))


#: Function words, and words for the work itself, which vary between notices.
_PLAIN = frozenset(b"""a an and any are as at be by can for from have if in is it its may no not of on or our see shall should that the their these
they this those to under was we which will with you your code file files library package program project repository software source work works""".split())
_WORDS = {family: [words_of(t) for t in texts] for family, texts in TEMPLATES.items()}
_TEMPLATE_PAIRS = {family: [_pairs(w) for w in texts] for family, texts in _WORDS.items()}


def overlap(words: list[bytes], family: str) -> float:
    """Greatest share of the paragraph's word pairs in a template, or of a template's in it."""
    mine = _pairs(words)
    return max((len(mine & t) / min(len(mine), len(t)) for t in _TEMPLATE_PAIRS[family] if min(len(mine), len(t)) >= 2), default=0.0)


def agreement(words: list[bytes], family: str) -> tuple[float, float, frozenset]:
    """How well the family's best template is aligned with the paragraph (0 if none confirms it),
    the share of that template, and which of the paragraph's telling words it has."""
    mine, best = _pairs(words), (0.0, 0.0, frozenset())
    telling = [w for w in words if w not in _PLAIN]
    for template, pairs in zip(_WORDS[family], _TEMPLATE_PAIRS[family]):
        if not mine & pairs:
            continue
        want = [w for w in template if w not in _PLAIN]
        blocks = [m for m in SequenceMatcher(None, telling, want, autojunk=False).get_matching_blocks() if m.size]
        same, places = sum(m.size for m in blocks), frozenset(k for m in blocks for k in range(m.a, m.a + m.size))
        if len(template) <= NOTICE:
            near = same == len(want) and blocks[-1].a + blocks[-1].size - blocks[0].a <= 2 * len(want) + 2
            most = len(want) + 2 if len(template) <= HEADING and template[0] != b"spdx" else 4 * len(want) + 8
            if near and len(telling) <= most:
                best = max(best, (1.0, 1.0, places), key=lambda x: (x[0], len(x[2])))
            continue
        covered, own = same / len(want), same / max(1, len(telling))
        if covered >= CONFIRM or (own >= COVERED and same >= 4):
            best = max(best, (max(covered, own), covered, places), key=lambda x: (x[0], len(x[2])))
    return best


@dataclass
class Model:
    classes: list[str]
    words: dict[bytes, int] = field(default_factory=dict)
    pairs: np.ndarray | None = None  # sorted codes first * (words + 1) + second
    weights: np.ndarray | None = None  # a row for each word, then for each pair, then one of zeros
    bias: np.ndarray | None = None
    temperature: float = 1.0
    threshold: float = 0.5

    def rows(self, batch: list[list[bytes]]) -> tuple[np.ndarray, np.ndarray]:
        """Feature numbers of many paragraphs, and where each begins (each ends with the zero row)."""
        none, sizes, get = len(self.words), np.array([len(w) + 1 for w in batch]), self.words.get
        out = np.fromiter((get(x, none) for w in batch for x in (*w, None)), np.int64)
        code = out * (none + 1)
        code[:-1] += out[1:]
        code[-1] += none
        at = np.searchsorted(self.pairs, code)
        hit = (at < len(self.pairs)) & (self.pairs[np.minimum(at, len(self.pairs) - 1)] == code)
        zero = len(self.weights) - 1
        both = np.stack([np.where(out < none, out, zero), np.where(hit, none + at, zero)], axis=1).ravel()
        return both, 2 * np.r_[0, np.cumsum(sizes)[:-1]]

    def families(self, words: list[bytes], p: np.ndarray) -> list[tuple[str, float]]:
        """(family, probability) of the families that a paragraph of class chances ``p`` is under."""
        if 1 - p[0] < self.threshold:
            return []
        fits = {family: agreement(words, family) for family in self.classes[1:]}
        fits = {family: (covered, places) for family, (fit, covered, places) in fits.items() if fit}

        def bettered(family: str) -> bool:
            covered, places = fits[family]
            return any(places < q or (places == q and c > covered) for c, q in fits.values())

        told = [(self.classes[k], float(p[k])) for k in np.flatnonzero(p >= SHARE) if k]
        return [x for x in told if x[0] in fits and not bettered(x[0])]

    def logits(self, batch: list[list[bytes]]) -> np.ndarray:
        rows, starts = self.rows(batch)
        size = np.array([len(w) for w in batch])
        return np.add.reduceat(self.weights[rows], starts, axis=0) / np.sqrt(np.maximum(size, 1))[:, None] + self.bias

    def probabilities(self, batch: list[list[bytes]]) -> np.ndarray:
        z = self.logits(batch) / self.temperature
        e = np.exp(z - z.max(axis=1, keepdims=True))
        return e / e.sum(axis=1, keepdims=True)


def _examples(templates: list[tuple[int, list[bytes]]], foreign: list[bytes], rng) -> list[tuple[int, list[bytes]]]:
    """(class, words): cut, thinned and mixed copies of the templates."""
    out = []
    for k, words in templates:
        for copy in range(COPIES):
            w = list(words)
            if copy and len(w) > 12:
                a = int(rng.integers(0, len(w) - 10))
                w = w[a : a + int(rng.integers(10, len(w)))]
            if copy:
                w = [x for x in w if rng.random() > 0.05]
                for _ in range(int(rng.integers(0, 4))):
                    w.insert(int(rng.choice([0, len(w)])), foreign[rng.integers(len(foreign))])
            if w:
                out.append((k, w))
    return out


def fit(data: list[tuple[int, list[bytes]]], rng) -> Model:
    """The logistic regression, by stochastic gradient descent."""
    model = Model(["unknown", *TEMPLATES])
    for _, words in data:
        for w in words:
            model.words.setdefault(w, len(model.words))
    none = len(model.words)
    model.pairs = np.unique([model.words[a] * (none + 1) + model.words[b] for _, w in data for a, b in zip(w, w[1:])]).astype(np.int64)
    model.weights = np.zeros((none + len(model.pairs) + 1, len(model.classes)), np.float32)
    model.bias = np.zeros(len(model.classes))
    steps, done = EPOCHS * len(data), 0
    for _ in range(EPOCHS):
        for i in rng.permutation(len(data)):
            k, words = data[i]
            rows, _ = model.rows([words])
            scale = 1 / np.sqrt(max(1, len(words)))
            z = model.weights[rows].sum(axis=0) * scale + model.bias
            p = np.exp(z - z.max())
            p /= p.sum()
            p[k] -= 1
            rate = 0.5 * (1 - done / steps)
            np.subtract.at(model.weights, rows, (rate * scale * p).astype(np.float32))
            model.weights[-1] = 0
            model.bias -= 0.02 * rate * p
            done += 1
    return model


def train(unknown: list[list[bytes]], seed: int = 11) -> Model:
    rng = np.random.default_rng(seed)
    foreign = [w for p in unknown[:200] for w in p] or [b"word"]
    plain = [p for p in unknown if len(p) >= LEAST_WORDS and all(overlap(p, f) < 0.3 for f in TEMPLATES)]
    plain = [(0, p) for p in plain + [words_of(t) for t in DISTRACTORS] * (COPIES // 4)]
    held, used, unseen = [], [], []
    for k, texts in enumerate(_WORDS.values(), 1):
        for i, words in enumerate(texts):
            (held if i % 5 == 4 else used).append((k, words))
    for i, p in enumerate(plain):
        (unseen if i % 5 == 4 else used).append(p)
    first = fit(_examples([x for x in used if x[0]], foreign, rng) + [x for x in used if not x[0]], rng)
    test = _examples(held, foreign, rng) + unseen
    z, truth = first.logits([w for _, w in test]), np.array([k for k, _ in test])

    def loss(t):
        q = z / t - (z / t).max(axis=1, keepdims=True)
        return float((np.log(np.exp(q).sum(axis=1)) - q[np.arange(len(q)), truth]).mean())

    model = fit(_examples(held + [x for x in used if x[0]], foreign, rng) + plain, rng)
    model.temperature = first.temperature = float(min(np.geomspace(0.2, 5, 40), key=loss))
    first.threshold = LIKELIER
    p = first.probabilities([words for _, words in unseen])
    alarms = sorted((1 - row[0] for (_, words), row in zip(unseen, p) if first.families(words, row)), reverse=True)
    allowed = int(ALARMS * len(unseen))
    model.threshold = float(max(LIKELIER, alarms[allowed] + 1e-6 if len(alarms) > allowed else 0.0))
    return model


def sampled_lines(docs: DataFrame, rows: int = UNKNOWN) -> list[str]:
    """The ``rows`` distinct lines with the smallest hashes, of all lines of all documents.  Only
    hashes under a cut leave the tasks; it lets 8 * ``rows`` through for a line a document."""
    cut = min(1.0, 8 * rows / max(1, docs.count()))

    def make():
        below = int(cut * 2**63)

        def fn(cols):
            found = {}
            for text in cols["text"]:
                for line in (text or "").split("\n"):
                    for at in range(0, len(line), PIECE):
                        piece = line[at : at + PIECE].strip()
                        h = xxhash.xxh3_64_intdigest(piece.encode()) >> 1
                        if piece and h < below:
                            found[h] = piece
            return {"h": list(found), "line": list(found.values())}

        return fn

    lines = map_rows(docs.select("text"), make, "h long, line string", ["text"]).groupBy("h").agg(F.min("line").alias("line"))
    return [r["line"] for r in lines.orderBy("h").limit(rows).collect()]


def learn(docs: DataFrame, rows: int = UNKNOWN) -> Model:
    return train([words_of(line) for line in sampled_lines(docs, rows)])


def scan(spark: SparkSession, docs: DataFrame, model: Model, carry: list[str] = ("doc_id",)) -> DataFrame:
    """The columns ``carry`` with n_paragraphs, and families, starts, ends and scores of the licence paragraphs."""
    sent = spark.sparkContext.broadcast(model)

    def make():
        m = sent.value

        def fn(cols):
            out = {c: [] for c in ("n_paragraphs", "families", "starts", "ends", "scores")}
            places, batch = [], []
            for i, text in enumerate(cols["text"]):
                spans = paragraphs(text)
                out["n_paragraphs"].append(len(spans))
                for c in ("families", "starts", "ends", "scores"):
                    out[c].append([])
                for a, b in spans:
                    words = words_of(text[a:b])
                    # without two words that a template has, no family can be confirmed
                    if len(words) >= LEAST_WORDS and sum(w in _ALL for w in words) >= 2:
                        places.append((i, a, b))
                        batch.append(words)
            for at in range(0, len(batch), 512):
                part = batch[at : at + 512]
                p = m.probabilities(part)
                for (i, a, b), words, row in zip(places[at:], part, p):
                    for family, share in m.families(words, row):
                        for c, v in (("families", family), ("starts", a), ("ends", b), ("scores", share)):
                            out[c][i].append(v)
            return out

        return fn

    return map_rows(docs, make, "n_paragraphs long, families array<string>, starts array<long>, ends array<long>, scores array<double>", ["text"], list(carry))


_ALL = {w for texts in TEMPLATES.values() for t in texts for w in words_of(t)}


def op1_license_scans(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All whole texts of ``documents``: how many paragraphs, how many of them under a licence, and which families."""
    docs = table(spark, sf_dir, "documents")
    found = scan(spark, docs, learn(docs))
    return found.select("doc_id", "n_paragraphs", F.size(F.array_distinct(F.arrays_zip("starts", "ends"))).cast("long").alias("n_licensed"),
                        F.array_join(F.array_sort(F.array_distinct("families")), ",").alias("families"))
