import math
from collections import Counter

import pytest

from quantpanel.llm import licenses
from quantpanel.llm.licenses import TEMPLATES, Matcher, scan_licences, terms
from tests.llm.tables import awkward


class Brute:
    """Every passage that a word or pair of a template places, by dense sums."""

    def __init__(self, texts):
        self.wordings = [(name, terms(t)) for name, wordings in TEMPLATES.items() for t in wordings]
        bags = [bag(w) for _, w in self.wordings]
        known = {t for b in bags for t in b}
        held = Counter(t for b in bags for t in b) + Counter(t for x in texts for t in bag(terms(x or "")) if t in known)
        total = len(texts) + len(bags)
        self.idf = lambda t: 1 + math.log((1 + total) / (1 + held[t]))
        self.vectors = [{t: n * self.idf(t) for t, n in b.items()} for b in bags]

    def passage(self, words):
        x = {t: n * self.idf(t) for t, n in bag(words).items()}
        best = {}
        for (name, _), y in zip(self.wordings, self.vectors):
            dot = sum(v * y.get(t, 0) for t, v in x.items())
            size = norm(y)
            best[name] = max(best.get(name, (0, 0)), (min(1.0, dot / norm(x) / size), size))
        cosine, size, name = max((c, size, n) for n, (c, size) in best.items())
        if cosine < licenses.LEAST_COSINE - 1e-9:
            return None
        tied = {n for n, (c, _) in best.items() if n and c > cosine - licenses.MARGIN}
        if name and len(tied) > 1:
            families = {n.split("-")[0] for n in tied}
            name = families.pop() if len(families) == 1 else ""
        return cosine**3 * size, name or None, cosine

    def text(self, text):
        words, spots = terms(text or ""), set()
        for _, wording in self.wordings:
            for shift in range(-len(wording), len(words)):
                if any(words[shift + i] == w for i, w in enumerate(wording) if 0 <= shift + i < len(words)):
                    spots.add((max(0, shift), len(wording)))
        best = (0, None, 0)
        for start, n in sorted(spots):
            if RARE & set(words[start : start + n]):  # the rest can't be near
                found = self.passage(words[start : start + n])
                best = max(best, found or best, key=lambda f: round(f[0], 8))
        return (best[1], best[2]) if best[1] else (None, 0.0)


def bag(words):
    return Counter([*words, *(f"{a} {b}" for a, b in zip(words, words[1:]))])


def norm(x):
    return math.sqrt(sum(v * v for v in x.values()))


RARE = set("license licensed licence spdx-license-identifier reserved permission redistribution form gnu domain creative cc source extent apache mit mozilla granted".split())


def test_documents_against_brute_force(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").selectExpr("doc_id", "text", "concat('d/', doc_id) as path")
    rows = docs.collect()
    brute = Brute([r.text for r in rows])
    got = {r.doc_id: r for r in scan_licences(docs).collect()}
    for r in rows:
        name, cosine = brute.text(r.text)
        assert got[r.doc_id].licence == name and got[r.doc_id].cosine == pytest.approx(cosine), r.text
    assert sum(r.licence is not None for r in got.values()) > 3


def test_each_wording_is_its_licence():
    matcher = Matcher(TEMPLATES)
    for name, wordings in TEMPLATES.items():
        for wording in wordings:
            assert matcher.text(f"Some title\n{wording}\nbody text follows here")[0] == (name or None), wording


def test_notices_inside_code_and_long_texts():
    apache = TEMPLATES["Apache-2.0"][0].split(" ")
    wrapped = "\n".join("# " + " ".join(apache[i : i + 6]) for i in range(0, len(apache), 6))
    assert Matcher(TEMPLATES).text(f"#!/bin/sh\n{wrapped}\nset -e")[0] == "Apache-2.0"
    long = "zzz yyy xxx. " * 60_000 + "\nReleased under the MIT License.\n" + "qqq. " * 1000
    assert Matcher(TEMPLATES).text(long)[0] == "MIT"


def files(spark, rows):
    return spark.createDataFrame([(i, p, t) for i, (p, t) in enumerate(rows)], "doc_id long, path string, text string")


def test_nearest_directory_speaks(spark):
    mit, gpl = "Released under the MIT License.", "SPDX-License-Identifier: GPL-3.0-only"
    rows = [("LICENSE", mit), ("a/x.py", "code"), ("a/b/COPYING", gpl), ("a/b/y.py", "code"), ("a/b/c/d/z.py", "code"), ("a/bb/q.py", "code"), ("a/b/m.py", mit), (None, "code"), (None, mit)]
    got = {r.doc_id: (r.licence, r.origin, r.declared_by) for r in scan_licences(files(spark, rows)).collect()}
    assert got == {0: ("MIT", "own", "LICENSE"), 1: ("MIT", "inherited", "LICENSE"), 2: ("GPL-3.0", "own", "a/b/COPYING"), 3: ("GPL-3.0", "inherited", "a/b/COPYING"), 4: ("GPL-3.0", "inherited", "a/b/COPYING"), 5: ("MIT", "inherited", "LICENSE"), 6: ("MIT", "own", "a/b/m.py"), 7: (None, "none", None), 8: ("MIT", "own", None)}


def test_any_file_speaks_for_its_directory(spark):
    rows = [("s/a/2", "Released under the MIT License."), ("s/a/1", "code"), ("s/b/1", "code"), ("s/a/3", "All rights reserved.")]
    got = {r.path: (r.licence, r.declared_by) for r in scan_licences(files(spark, rows), any_file=True).collect()}
    assert got["s/a/1"] == ("MIT", "s/a/2") and got["s/b/1"] == (None, None) and got["s/a/3"] == ("Proprietary", "s/a/3")
    assert scan_licences(files(spark, [])).count() == 0


def test_awkward_rows(spark):
    frame = awkward(spark).selectExpr("*", "concat('x/', doc_id) as path", "'clash' as dir", "'clash' as licence")
    assert scan_licences(frame).count() == 13


GNU = "This program is free software; you can redistribute it and/or modify it under the terms of the GNU {} License as published by the Free Software Foundation; either version {} of the License, or (at your option) any later version."


@pytest.mark.parametrize("text, licence", [
    ("This library is released under the MIT License.", "MIT"),
    ("This library is licensed under the Apache License, Version 2.0.", "Apache-2.0"),
    (GNU.format("Lesser General Public", "2.1").replace("program", "library"), "LGPL-2.1"),
    ("SPDX-License-Identifier: Apache-2.0 WITH LLVM-exception", "Apache-2.0 WITH LLVM-exception"),
    ("/* SPDX-License-Identifier: (MIT OR Apache-2.0) */", "MIT OR Apache-2.0"),
    ("# SPDX-License-Identifier: MIT AND", None),
    ("Not licensed under the MIT License.", None),
    ("Licensed under the GPL.", "GPL"),
    ("This work is licensed under the BSD License.", "BSD"),
    (GNU.format("Affero General Public", "3"), "AGPL-3.0"),
    (GNU.format("General Public", "2"), "GPL-2.0"),
    (GNU.format("General Public", "3"), "GPL-3.0"),
    (GNU.format("Lesser General Public", "2.1"), "LGPL-2.1"),
    ("This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License.", "CC-BY-SA-4.0"),
    ("This software is released under the ISC License.", "ISC"),
    ("Released under the Zlib License.", None),
    ("This is free and unencumbered software released into the public domain, for all.", "Unlicense"),
    ("// SPDX-License-Identifier: ISC", "ISC"),
    ("# SPDX-License-Identifier: AGPL-3.0-or-later", "AGPL-3.0"),
    ("# SPDX-License-Identifier: BSD-2-Clause", "BSD-2-Clause"),
    ("# SPDX-License-Identifier: Zlib", None),
])
def test_wordings_that_are_no_templates(text, licence):
    assert Matcher(TEMPLATES).text(f"Title\n{text}\nbody of the file")[0] == licence
