"""Licence paragraphs in wordings that are no template, texts that only speak of licences, and the sample of lines."""

import numpy as np
import pytest
import xxhash

from clickrate.llm import licences
from clickrate.llm.common import table

# Public licence wording, and sentences that grant nothing.
YES = [
    ("MIT", "THE SOFTWARE IS PROVIDED \"AS IS\", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT."),
    ("MIT", "MIT License"), ("MIT", "My tool is licensed under the MIT license"), ("MIT", "Permission is hereby granted, free of charge, to any person obtaining"),
    ("Apache-2.0", "Apache License"), ("Apache-2.0", "Licensed under the Apache License, Version 2.0 (the \"License\");"), ("Apache-2.0", "you may not use this file except in compliance with the License."),
    ("Apache-2.0", "2. Grant of Copyright License. Subject to the terms and conditions of this License, each Contributor hereby grants to You a perpetual, worldwide, non-exclusive, no-charge, royalty-free, irrevocable copyright license"),
    ("GPL", "This program is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; without even the implied warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE. See the GNU General Public License for more details."),
    ("GPL", "Foobar is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation, either version 2 of the License, or (at your option) any later version."),
    ("GPL", "The GNU General Public License is a free, copyleft license for software and other kinds of works."),
    ("LGPL", "This library is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; without even the implied warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE. See the GNU Lesser General Public License for more details."),
    ("AGPL", "You should have received a copy of the GNU Affero General Public License along with this server."),
    ("BSD", "THIS SOFTWARE IS PROVIDED BY THE REGENTS AND CONTRIBUTORS \"AS IS\" AND ANY EXPRESS OR IMPLIED WARRANTIES, INCLUDING, BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE DISCLAIMED."),
    ("BSD", "Neither the name of Example Corp. nor the names of its contributors may be used to endorse or promote products derived from this software without specific prior written permission."),
    ("BSD", "* Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer in the documentation"),
    ("EPL", "This program and the accompanying materials are made available under the terms of the Eclipse Public License 2.0"),
    ("zlib", "This software is provided 'as-is', without any express or implied warranty."), ("zlib", "2. Altered source versions must be plainly marked as such, and must not be misrepresented as being the original software."),
    ("MPL-2.0", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0."), ("ISC", "Permission to use, copy, modify, and distribute this software for any purpose with or without fee is hereby granted"),
    ("MIT,Apache-2.0", "SPDX-License-Identifier: MIT OR Apache-2.0"), ("CC-BY-SA", "This text is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License"),
]
NO = [
    "This project is discussed under the terms of the MIT license debate.", "You should have received a copy of the magazine along with this program of events.", "He renewed his driver's license in May.",
    "The general public was free to redistribute the leaflets.", "All rights reserved.", "The Apache people lived in the southwest.", "The warranty covers parts for two years.", "Students of MIT wrote the report.",
    "The publisher granted permission to print the poem.", "Without prior written permission nobody may enter the building.", "The Eclipse was seen by the general public.", "Mozilla published a new browser, version 2.0.",
]


@pytest.fixture(scope="module")
def docs(spark):
    return table(spark, "/root/testdata/sf0.01", "documents")


@pytest.fixture(scope="module")
def model(docs):
    return licences.learn(docs)


def families(model, text):
    words = licences.words_of(text)
    return {f for f, _ in model.families(words, model.probabilities([words])[0])}


def test_recall_and_false_alarms(model):
    missed = [t for want, t in YES if families(model, t) != set(want.split(","))]
    assert len(missed) <= 0.1 * len(YES), missed
    assert not [t for t in NO if families(model, t)]
    assert licences.LIKELIER <= model.threshold < 1 and 0.2 < model.temperature < 5


def test_lines_of_documents(spark, docs, model):
    """At most a hundredth of the lines without a licence word, and every line that is a template."""
    templates = {t for texts in licences.TEMPLATES.values() for t in texts}
    lines = {line.strip() for r in docs.select("text").collect() for line in (r["text"] or "").split("\n")}
    plain = sorted(x for x in lines if licences.words_of(x) and "licen" not in x.lower() and "SPDX" not in x and x not in templates)[:20_000]
    assert len(plain) > 1000 and sum(bool(families(model, x)) for x in plain) <= 0.01 * len(plain)
    assert all(families(model, x) for x in lines & templates)


def test_held_back_templates_choose_no_other_family(docs):
    """A template whose family learns only from its other templates is reported under no foreign family."""
    lines = [licences.words_of(x) for x in licences.sampled_lines(docs, 500)]
    rng = np.random.default_rng(0)
    for drop in (1, 3):
        data, held = [], []
        for k, texts in enumerate(licences._WORDS.values(), 1):
            for i, words in enumerate(texts):
                (held if i % 5 == drop else data).append((k, words))
        fitted = licences.fit(licences._examples(data, [b"word"], rng) + [(0, p) for p in lines if p], rng)
        p = fitted.probabilities([w for _, w in held])
        told = [[fitted.classes.index(f) for f, _ in fitted.families(w, row)] for (_, w), row in zip(held, p)]
        wrong = [(b" ".join(w), [fitted.classes[x] for x in t]) for t, (k, w) in zip(told, held) if set(t) - {k}]
        assert len(wrong) <= 0.1 * len(held), wrong


@pytest.mark.parametrize("rows", [5, 100_000])
def test_sampled_lines_are_the_smallest_hashes_of_all(spark, rows):
    texts = ["a b\n\nc d\n" + "x" * 1300, "c d\n e f ", None, "", "g"] * 3
    pieces = {"a b", "c d", "x" * 600, "x" * 100, "e f", "g"}
    got = licences.sampled_lines(spark.createDataFrame([(t,) for t in texts], "text string").repartition(4), rows)
    assert got == sorted(pieces, key=lambda x: xxhash.xxh3_64_intdigest(x.encode()) >> 1)[:rows]


def test_nulls_repeats_ties_and_clashing_columns(spark, model):
    rows = [(1, "MIT License\nSPDX-License-Identifier: MIT OR Apache-2.0\n", "s", 1), (1, "MIT License", "s", 2), (None, None, None, None), (2, "", "", 0), (3, "w " * 50_000, "x", 3)]
    got = licences.scan(spark, spark.createDataFrame(rows, "doc_id long, text string, families string, n_paragraphs long"), model).collect()
    said = sorted((r["doc_id"] or 0, r["n_paragraphs"], sorted(set(r["families"]))) for r in got)
    assert said == [(0, 0, []), (1, 1, ["MIT"]), (1, 3, ["Apache-2.0", "MIT"]), (2, 0, []), (3, 1, [])]
