"""Licence scan: notices by text similarity, then inheritance along directories.

The passages of a file are compared with licence templates by the cosine of sparse TF-IDF vectors over words
and pairs of words, with document frequencies counted over the corpus. Passages are as long as a template
and may lie anywhere in the text: headers, the ends of files and whole licence files are all read. A directory has the licence that its licence file,
or else its first file by name, declares; a file without a notice of its own inherits from the
nearest directory above it that has one, found by joining paths with their ancestors.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quantpanel.functions.storage import materialise
from quantpanel.llm.rows import bounded_batches, map_batches

# Names and wordings of common licence notices.
TEMPLATES = {
    "Apache-2.0": [
        "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in compliance with the License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0",
        "Licensed under the Apache License, Version 2.0.",
        "SPDX-License-Identifier: Apache-2.0",
    ],
    "MIT": [
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the \"Software\"), to deal in the Software without restriction",
        "Released under the MIT License.",
        "Licensed under the MIT License. See License.txt in the project root for license information.",
        "SPDX-License-Identifier: MIT",
    ],
    "GPL-3.0": [
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version.",
        "This work is licensed under the GNU General Public License, version 3.",
        "SPDX-License-Identifier: GPL-3.0-only",
    ],
    "BSD-3-Clause": [
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met",
        "Use of this source code is governed by a BSD-style license that can be found in the LICENSE file.",
        "SPDX-License-Identifier: BSD-3-Clause",
    ],
    "MPL-2.0": [
        "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was not distributed with this file, You can obtain one at http://mozilla.org/MPL/2.0/.",
        "SPDX-License-Identifier: MPL-2.0",
    ],
    "CC-BY-4.0": [
        "This work is licensed under a Creative Commons Attribution 4.0 International License.",
        "Licensed under CC BY 4.0.",
        "SPDX-License-Identifier: CC-BY-4.0",
    ],
    "CC-BY-NC-4.0": [
        "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License.",
        "Licensed under CC BY-NC 4.0.",
        "SPDX-License-Identifier: CC-BY-NC-4.0",
    ],
    "Proprietary": ["All rights reserved."],
    "CC0-1.0": [
        "To the extent possible under law, the author has waived all copyright and related or neighboring rights to this work.",
        "SPDX-License-Identifier: CC0-1.0",
    ],
}

# Further licences and variants; names as they stand in the usual notices.
_NAMED = {
    "Apache-2.0": ("Apache License 2.0", "Apache-2.0 License"),
    "MIT": ("MIT License",),
    "ISC": ("ISC License",),
    "BSD-2-Clause": ("BSD 2-Clause License", "Simplified BSD License", "BSD-2-Clause License"),
    "BSD-3-Clause": ("BSD 3-Clause License", "New BSD License", "BSD-3-Clause License"),
    "GPL-2.0": ("GNU General Public License, version 2", "GPL v2", "GPLv2"),
    "GPL-3.0": ("GNU General Public License, version 3", "GPL v3", "GPLv3"),
    "LGPL-2.1": ("GNU Lesser General Public License, version 2.1", "LGPL v2.1", "LGPLv2.1"),
    "LGPL-3.0": ("GNU Lesser General Public License, version 3", "LGPL v3", "LGPLv3"),
    "AGPL-3.0": ("GNU Affero General Public License, version 3", "AGPL v3", "AGPLv3"),
    "MPL-2.0": ("Mozilla Public License 2.0", "MPL 2.0"),
    "CC-BY-SA-4.0": ("Creative Commons Attribution-ShareAlike 4.0 International License", "CC BY-SA 4.0"),
    "CC-BY-ND-4.0": ("Creative Commons Attribution-NoDerivatives 4.0 International License", "CC BY-ND 4.0"),
    "CC-BY-NC-SA-4.0": ("Creative Commons Attribution-NonCommercial-ShareAlike 4.0 International License", "CC BY-NC-SA 4.0"),
}
_GNU = 'This program is free software: you can redistribute it and/or modify it under the terms of the GNU {} as published by the Free Software Foundation, either version {} of the License, or (at your option) any later version.'
_FURTHER = {
    "GPL-2.0": [_GNU.format("General Public License", "2"), "SPDX-License-Identifier: GPL-2.0-only", "SPDX-License-Identifier: GPL-2.0-or-later"],
    "GPL-3.0": ["SPDX-License-Identifier: GPL-3.0-or-later"],
    "LGPL-2.1": [_GNU.format("Lesser General Public License", "2.1"), "SPDX-License-Identifier: LGPL-2.1-only", "SPDX-License-Identifier: LGPL-2.1-or-later"],
    "LGPL-3.0": [_GNU.format("Lesser General Public License", "3"), "SPDX-License-Identifier: LGPL-3.0-only", "SPDX-License-Identifier: LGPL-3.0-or-later"],
    "AGPL-3.0": [_GNU.format("Affero General Public License", "3"), "SPDX-License-Identifier: AGPL-3.0-only", "SPDX-License-Identifier: AGPL-3.0-or-later"],
    "BSD-2-Clause": ["SPDX-License-Identifier: BSD-2-Clause"],
    "ISC": ["Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the above copyright notice and this permission notice appear in all copies.", "SPDX-License-Identifier: ISC"],
    "Unlicense": ["This is free and unencumbered software released into the public domain.", "SPDX-License-Identifier: Unlicense"],
    **{
        name: [f"SPDX-License-Identifier: {name}", f"This work is licensed under a {wordings[0]}."]
        for name, wordings in _NAMED.items() if name.startswith("CC-BY-")
    },
}
for _name, _wordings in _NAMED.items():
    TEMPLATES.setdefault(_name, []).extend(f"{verb} under the {w}." for w in _wordings for verb in ("Licensed", "Released"))
for _name, _wordings in _FURTHER.items():
    TEMPLATES.setdefault(_name, []).extend(_wordings)
TEMPLATES = {name: list(dict.fromkeys(wordings)) for name, wordings in TEMPLATES.items()}

# Wordings without a version; the licence is then known as a family only.
_FAMILIES = {
    "GPL": ("GPL", "GNU GPL", "GNU General Public License"),
    "LGPL": ("LGPL", "GNU LGPL", "GNU Lesser General Public License"),
    "AGPL": ("AGPL", "GNU AGPL", "GNU Affero General Public License"),
    "BSD": ("BSD License", "BSD licence"),
    "Apache": ("Apache License",),
    "MPL": ("MPL", "Mozilla Public License"),
}
for _name, _wordings in _FAMILIES.items():
    TEMPLATES[_name] = [f"{verb} under the {w}." for w in _wordings for verb in ("Licensed", "Released")]
# Sentences that deny a licence are templates too, of no licence.
DENIED = ""
TEMPLATES[DENIED] = [
    f"not {sentence}" for name, wordings in list(TEMPLATES.items()) for sentence in wordings
    if sentence.startswith(("Licensed under", "Released under"))
]

LEAST_COSINE = 0.6
MARGIN = 0.005  # over the second licence in one passage
LICENCE_FILE = r"(?i)^(licen[cs]e|copying|unlicense|notice)([._-].*)?$"

_INSIDE = ".+-"  # characters that may stand inside a word
_words = bytes(b if chr(b).isalnum() and b < 128 or chr(b) in _INSIDE else ord(" ") for b in range(256))
_spdx = re.compile(r"spdx-license-identifier:[ \t]*([a-z0-9.+() \t-]+)", re.IGNORECASE)


def terms(text: str) -> list[str]:
    """ASCII letters and digits in lower case, with dots, plus and minus signs inside a word."""
    plain = text.lower().encode("ascii", "replace").translate(_words).decode("ascii")
    return [w for w in (x.strip(_INSIDE) for x in plain.split()) if w]


def features(words: list[str]) -> Counter:
    """Words and pairs of neighbours of a passage."""
    return Counter(words) + Counter(map(" ".join, zip(words, words[1:])))


def vocabulary(templates: dict[str, list[str]]) -> list[str]:
    return sorted({t for wordings in templates.values() for w in wordings for t in features(terms(w))})


def document_frequencies(files: DataFrame, templates: dict[str, list[str]]) -> tuple[int, dict[str, int]]:
    """The number of texts, and how many of them hold each word and pair of the templates."""
    known = vocabulary(templates)
    place = {tuple(t.split(" ")) if " " in t else t: i for i, t in enumerate(known)}
    bounded_batches(files.sparkSession)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, texts, pairs = [0] * len(known), 0, {t for t in place if isinstance(t, tuple)}
        for batch in batches:
            for text in batch.column("text").to_pylist():
                words = terms(text or "")
                met = place.keys() & set(words)
                for t in met | pairs.intersection(zip(words, words[1:])):
                    held[place[t]] += 1
                texts += 1
        yield pa.RecordBatch.from_arrays([pa.array([-1, *range(len(known))]), pa.array([texts, *held])], ["term", "n"])

    rows = files.select(F.col("text").cast("string").alias("text")).mapInArrow(count, "term long, n long")
    sums = {r.term: r.n for r in rows.groupBy("term").agg(F.sum("n").alias("n")).collect()}  # one row per term
    return sums.get(-1, 0), {t: sums.get(i, 0) for i, t in enumerate(known)}


class Matcher:
    """TF-IDF vectors of the templates over words and pairs of words.

    Idf counts the texts of the corpus and the templates as documents. A passage of a text is as long as a
    template, and lies so that a mark of the template stands at the same place in both.
    """

    def __init__(
        self,
        templates: dict[str, list[str]],
        least: float = LEAST_COSINE,
        texts: int = 0,
        held: dict[str, int] | None = None,
    ) -> None:
        self.least = least
        words = [(name, terms(t)) for name, wordings in sorted(templates.items()) for t in wordings]
        bags = [features(w) for _, w in words]
        own = Counter(t for bag in bags for t in bag)
        total = texts + len(bags)
        self.idf = {t: 1 + math.log((1 + total) / (1 + n + (held or {}).get(t, 0))) for t, n in own.items()}
        self.rare = 1 + math.log(1 + total)
        self.names = [name for name, _ in words]
        self.known = {name.lower(): name for name in templates if name}
        self.sizes = [math.sqrt(sum((n * self.idf[t]) ** 2 for t, n in bag.items())) for bag in bags]
        self.vectors: dict[str, list[tuple[int, float]]] = {}
        self.marks: dict[str, set[tuple[int, int]]] = {}  # (place in the template, its length) of each mark
        for i, bag in enumerate(bags):
            parts = sorted((n * self.idf[t] / self.sizes[i], t) for t, n in bag.items())
            for part, t in parts:
                self.vectors.setdefault(t, []).append((i, part))
            for t in self._marks(parts, least):
                for at in _places(words[i][1], t):
                    self.marks.setdefault(t, set()).add((at, len(words[i][1])))
        # the rarer word of a mark finds it: (words from it to the mark, the mark's words)
        self.anchors: dict[str, list[tuple[int, list[str]]]] = {}
        for t in self.marks:
            parts = t.split(" ")
            rarest = max(range(len(parts)), key=lambda i: self.idf[parts[i]])
            self.anchors.setdefault(parts[rarest], []).append((rarest, parts))

    @staticmethod
    def _marks(parts: list[tuple[float, str]], least: float) -> list[str]:
        """Terms of which any passage as near as ``least`` has one: the lighter ones alone don't reach it."""
        common = 0.0
        for i, (part, _) in enumerate(parts):
            common += part * part
            if common >= least**2 - 1e-9:
                return [t for _, t in parts[i:]]
        return []

    def cosines(self, words: list[str]) -> dict[str, tuple[float, float]]:
        """Per licence the cosine of its nearest wording, and the length of that one's vector."""
        dots: dict[int, float] = {}
        total = 0.0
        for term, n in features(words).items():
            weight = n * self.idf.get(term, self.rare)
            total += weight * weight
            for i, part in self.vectors.get(term, ()):
                dots[i] = dots.get(i, 0.0) + weight * part
        found: dict[str, tuple[float, float]] = {}
        for i, dot in dots.items():
            found[self.names[i]] = max(found.get(self.names[i], (0.0, 0.0)), (min(1.0, dot / math.sqrt(total)), self.sizes[i]))
        return found

    def passages(self, words: list[str]) -> list[tuple[int, int]]:
        """Start and length of the passages that a mark places."""
        found = set()
        if self.anchors.keys().isdisjoint(words):
            return []
        for i, word in enumerate(words):
            for before, parts in self.anchors.get(word, ()):
                start = i - before
                if start >= 0 and words[start : start + len(parts)] == parts:
                    found |= {(max(0, start - at), length) for at, length in self.marks[" ".join(parts)]}
        return sorted(found)

    def judged(self, words: list[str]) -> tuple[float, str | None, float] | None:
        """Evidence, licence and cosine of a passage; None if nothing is near.

        Licences that are equally near are told by their family, if they have one in common.
        """
        near = sorted(((c, size, name) for name, (c, size) in self.cosines(words).items()), reverse=True)
        if not near or near[0][0] < self.least - 1e-9:
            return None
        cosine, size, name = near[0]
        tied = [n for c, _, n in near if c > cosine - MARGIN and n != DENIED]
        if name != DENIED and len(tied) > 1:
            families = {n.split("-")[0] for n in tied}
            name = families.pop() if len(families) == 1 else DENIED
        return cosine**3 * size, name or None, cosine

    def text(self, text: str | None) -> tuple[str | None, float]:
        """Licence and cosine of a whole text.

        An SPDX line is taken at its word, with AND, OR and WITH, if its licences are known. Otherwise the passage
        with the most evidence (the cubed cosine times the length of the wording's vector) decides; of equals the first.
        """
        stated = _spdx.search(text or "")
        if stated:
            name = self.spdx(stated.group(1))
            return (name, 1.0) if name else (None, 0.0)
        words = terms(text or "")
        best = (0.0, None, 0.0)
        for start, length in self.passages(words):
            found = self.judged(words[start : start + length])
            if found is not None and found[0] > best[0] + 1e-9:
                best = found
        return (best[1], best[2]) if best[1] is not None else (None, 0.0)

    def spdx(self, expression: str) -> str | None:
        """The expression with the names used here; None if it names an unknown licence or is none."""
        out, wanted, exception = [], True, False
        for token in expression.replace("(", " ").replace(")", " ").split():
            upper = token.upper()
            if exception:
                out.append(token)
                exception, wanted = False, False
            elif upper in ("AND", "OR", "WITH"):
                if wanted:
                    return None
                out.append(upper)
                wanted, exception = upper != "WITH", upper == "WITH"
            elif wanted:
                name = self.known.get(re.sub(r"(-only|-or-later|\+)$", "", token.lower()))
                if name is None:
                    return None
                out.append(name)
                wanted = False
            else:
                break  # text behind the expression
        return None if wanted or exception or not out else " ".join(out)


def _places(words: list[str], term: str) -> list[int]:
    parts = term.split(" ")
    return [i for i in range(len(words) - len(parts) + 1) if words[i : i + len(parts)] == parts]


_matchers: dict[str, Matcher] = {}


def own_notices(files: DataFrame, templates: dict[str, list[str]], least: float) -> DataFrame:
    """``doc_id, path`` with the licence that a file's own text declares, and its cosine."""
    texts, held = document_frequencies(files, templates)
    key = repr((sorted(templates.items()), least, texts, sorted(held.items())))

    def scan(batch: pa.RecordBatch) -> dict:
        if key not in _matchers:
            _matchers.clear()
            _matchers[key] = Matcher(templates, least, texts, held)
        found = [_matchers[key].text(t) for t in batch.column("text").to_pylist()]
        return {
            "doc_id": batch.column("doc_id"),
            "path": batch.column("path"),
            "licence": [f[0] for f in found],
            "cosine": [f[1] for f in found],
        }

    rows = files.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        F.col("path").cast("string").alias("path"),
        F.col("text").cast("string").alias("text"),
    )
    return map_batches(rows, scan, "doc_id long, path string, licence string, cosine double")


def _directory(path: Column) -> Column:
    return F.regexp_extract(path, "^(.*)/[^/]*$", 1)


def scan_licences(
    files: DataFrame,
    templates: dict[str, list[str]] = TEMPLATES,
    least: float = LEAST_COSINE,
    any_file: bool = False,
) -> DataFrame:
    """``doc_id, path, licence, origin, cosine, declared_by`` of every row of doc_id, path, text.

    ``origin`` is own, inherited or none; ``declared_by`` the path of the file whose notice counts.
    A directory's licence is that of its licence file, by name; with ``any_file`` a
    directory without one takes that of its first file, by path, with a notice. The empty
    directory above all is an ancestor too. Null texts declare nothing; a null path has no
    directory and inherits nothing. Of equal paths, all rows are scanned and the smallest licence
    name speaks for the directory.
    """
    own = materialise(own_notices(files, templates, least).withColumn("dir", _directory(F.col("path"))))
    named = F.regexp_extract(F.col("path"), "([^/]*)$", 1).rlike(LICENCE_FILE)
    speaking = own.where("licence is not null and path is not null")
    if not any_file:
        speaking = speaking.where(named)
    declared = (
        speaking.groupBy(F.col("dir").alias("ancestor"))
        .agg(F.min(F.struct((~named).alias("other"), "path", "licence")).alias("by"))
        .select("ancestor", F.col("by.licence").alias("dir_licence"), F.col("by.path").alias("dir_path"))
    )
    parts = F.split("dir", "/")
    above = F.transform(
        F.sequence(F.lit(0), F.size(parts)), lambda n: F.array_join(F.slice(parts, F.lit(1), n), "/")
    )
    nearest = (
        own.where("dir is not null")
        .select("dir")
        .distinct()
        .select("dir", F.explode(F.array_distinct(above)).alias("ancestor"))
        .join(declared, "ancestor")
        .groupBy("dir")
        .agg(F.max(F.struct(F.length("ancestor").alias("depth"), "dir_licence", "dir_path")).alias("near"))
        .select("dir", F.col("near.dir_licence").alias("near_licence"), F.col("near.dir_path").alias("near_path"))
    )
    has_own, inherits = F.col("licence").isNotNull(), F.col("near_licence").isNotNull()
    return own.join(nearest, "dir", "left").select(
        "doc_id",
        "path",
        F.coalesce("licence", "near_licence").alias("licence"),
        F.when(has_own, "own").when(inherits, "inherited").otherwise("none").alias("origin"),
        "cosine",
        F.when(has_own, F.col("path")).otherwise(F.col("near_path")).alias("declared_by"),
    )
