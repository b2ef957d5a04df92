"""License scans by patience alignment.

A license template is aligned with the places of a text that could hold it: words that occur once
in the text piece and once in the template are anchors, the longest increasing subsequence of
their positions keeps the order, and the gaps between anchors are aligned the same way.  The
share of the template's words that find a partner is its coverage.
"""

from __future__ import annotations

from bisect import bisect_left
from collections import Counter
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from roadlark.llm.common import slices
from roadlark.llm.decontaminate import words

COVERAGE = 0.85
# Of the words between the first and the last match, this share has to match.
DENSITY = 0.5
SLICE_BYTES = 1 << 20

# The wording of common license notices.
TEMPLATES = [
    ("MIT", "Released under the MIT License."),
    ("MIT", "Licensed under the MIT License."),
    (
        "MIT",
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this"
        " software and associated documentation files (the \"Software\"), to deal in the Software"
        " without restriction, including without limitation the rights to use, copy, modify,"
        " merge, publish, distribute, sublicense, and/or sell copies of the Software, and to"
        " permit persons to whom the Software is furnished to do so, subject to the following"
        " conditions: The above copyright notice and this permission notice shall be included in"
        " all copies or substantial portions of the Software.",
    ),
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0."),
    (
        "Apache-2.0",
        "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this"
        " file except in compliance with the License. You may obtain a copy of the License at"
        " http://www.apache.org/licenses/LICENSE-2.0 Unless required by applicable law or agreed"
        " to in writing, software distributed under the License is distributed on an \"AS IS\""
        " BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied.",
    ),
    ("GPL-3.0", "This work is licensed under the GNU General Public License, version 3."),
    (
        "GPL-3.0",
        "This program is free software: you can redistribute it and/or modify it under the terms"
        " of the GNU General Public License as published by the Free Software Foundation, either"
        " version 3 of the License, or (at your option) any later version.",
    ),
    (
        "GPL-2.0",
        "This program is free software; you can redistribute it and/or modify it under the terms"
        " of the GNU General Public License as published by the Free Software Foundation; either"
        " version 2 of the License, or (at your option) any later version.",
    ),
    ("CC-BY-NC-4.0", "Licensed under CC BY-NC 4.0."),
    (
        "CC-BY-NC-4.0",
        "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0"
        " International License.",
    ),
    ("CC-BY-4.0", "Licensed under CC BY 4.0."),
    (
        "CC-BY-4.0",
        "This work is licensed under a Creative Commons Attribution 4.0 International License.",
    ),
    (
        "BSD",
        "Redistribution and use in source and binary forms, with or without modification, are"
        " permitted provided that the following conditions are met: Redistributions of source"
        " code must retain the above copyright notice, this list of conditions and the following"
        " disclaimer. Redistributions in binary form must reproduce the above copyright notice,"
        " this list of conditions and the following disclaimer in the documentation and/or other"
        " materials provided with the distribution.",
    ),
    (
        "ISC",
        "Permission to use, copy, modify, and/or distribute this software for any purpose with or"
        " without fee is hereby granted, provided that the above copyright notice and this"
        " permission notice appear in all copies.",
    ),
    (
        "MPL-2.0",
        "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0.",
    ),
    (
        "Unlicense",
        "This is free and unencumbered software released into the public domain. Anyone is free"
        " to copy, modify, publish, use, compile, sell, or distribute this software.",
    ),
]


def increasing(values: list[int]) -> list[int]:
    """Indices of a longest increasing subsequence, by patience sorting."""
    tops: list[int] = []
    piles: list[int] = []
    before = [-1] * len(values)
    for i, v in enumerate(values):
        pile = bisect_left(tops, v)
        if pile == len(tops):
            tops.append(v)
            piles.append(i)
        else:
            tops[pile], piles[pile] = v, i
        before[i] = piles[pile - 1] if pile else -1
    out, at = [], piles[-1] if piles else -1
    while at >= 0:
        out.append(at)
        at = before[at]
    return out[::-1]


def aligned(text: list[int], template: list[int]) -> list[tuple[int, int]]:
    """Matched (text, template) positions, in order."""
    out = []
    gaps = [(0, len(text), 0, len(template))]
    while gaps:
        a, b, c, d = gaps.pop()
        while a < b and c < d and text[a] == template[c]:
            out.append((a, c))
            a, c = a + 1, c + 1
        while a < b and c < d and text[b - 1] == template[d - 1]:
            b, d = b - 1, d - 1
            out.append((b, d))
        if a == b or c == d:
            continue
        once = Counter(text[a:b])
        mine = Counter(template[c:d])
        place = {w: i for i, w in enumerate(text[a:b], a) if once[w] == 1}
        anchors = [
            (i, place[w]) for i, w in enumerate(template[c:d], c) if mine[w] == 1 and w in place
        ]
        anchors = [anchors[k] for k in increasing([p for _, p in anchors])]
        if not anchors:
            continue
        edge = [(c - 1, a - 1), *anchors, (d, b)]
        out += [(p, i) for i, p in anchors]
        for (i, p), (j, q) in zip(edge, edge[1:]):
            gaps.append((p + 1, q, i + 1, j))
    return sorted(out)


@dataclass
class Template:
    license: str
    words: list[int]
    counts: dict[int, int]
    terms: np.ndarray  # sorted


def prepared(templates: list[tuple[str, str]]) -> list[Template]:
    out = []
    for name, text in templates:
        h = words(pa.array([text]))[0]
        if len(h):
            out.append(Template(name, h.tolist(), Counter(h.tolist()), np.unique(h)))
    return out


def found_in(templates: list[Template], texts, coverage: float, density: float):
    """(text, license, coverage, start, end, matched) for a batch of texts, in bytes.

    A covered template shows all of its words but a small share, so at least one of any larger
    share of them; the places of the batch's rarest of these words are all that is looked at.
    """
    hashes, owner, begin, end = words(texts)
    if not len(hashes):
        return
    vocabulary = np.unique(np.concatenate([t.terms for t in templates]))
    at = np.minimum(np.searchsorted(vocabulary, hashes), len(vocabulary) - 1)
    known = np.flatnonzero(vocabulary[at] == hashes)
    at = at[known]
    count = np.bincount(at, minlength=len(vocabulary))
    by = np.argsort(at, kind="stable")
    cut = np.concatenate(([0], np.cumsum(count)))
    first = np.searchsorted(owner, np.arange(len(texts) + 1))
    rows = []
    for t in templates:
        m = len(t.words)
        number = np.searchsorted(vocabulary, t.terms)
        number = number[np.argsort(count[number], kind="stable")]
        copies = np.array([t.counts[int(vocabulary[k])] for k in number])
        # So many words may be missing; one word more must show one.
        enough = int(np.searchsorted(np.cumsum(copies), m - int(np.ceil(coverage * m)) + 1)) + 1
        seeds = np.concatenate([known[by[cut[k] : cut[k + 1]]] for k in number[:enough]])
        done = -1
        for seed in np.sort(seeds).tolist():
            if seed < done:
                continue
            low = max(int(first[owner[seed]]), seed - 2 * m)
            high = min(int(first[owner[seed] + 1]), seed + 2 * m)
            piece = hashes[low:high].tolist()
            here = Counter(w for w in piece if w in t.counts)
            if sum(min(here[w], n) for w, n in t.counts.items()) < coverage * m:
                continue
            # The nearest stretch of the template's length around the seed, then a wider one.
            for reach in (m, 2 * m):
                a, b = max(low, seed - reach), min(high, seed + reach)
                pairs = aligned(hashes[a:b].tolist(), t.words)
                if len(pairs) >= coverage * m:
                    p, q = a + pairs[0][0], a + pairs[-1][0]
                    if len(pairs) >= density * (q - p + 1) and p <= seed <= q:
                        where = int(begin[p]), int(end[q])
                        rows.append((int(owner[seed]), t.license, len(pairs) / m, *where, len(pairs)))
                        done = q + 1
                        break
    # Of overlapping finds, that of the most words and the best coverage counts.
    taken: dict[int, list] = {}
    for row in sorted(rows, key=lambda r: (-r[5], -r[2], r)):
        others = taken.setdefault(row[0], [])
        if all(row[4] <= s or e <= row[3] for s, e in others):
            others.append((row[3], row[4]))
            yield row


def scan(
    documents: DataFrame,
    templates: list[tuple[str, str]] | None = None,
    coverage: float = COVERAGE,
    density: float = DENSITY,
) -> DataFrame:
    """(doc_id, license, coverage, start, end, words): the license notices in ``documents``.

    ``templates`` are pairs of a license and a wording.  start and end count bytes of the
    lower-case UTF-8 text, words the matched words.  Case and punctuation do not matter.  Whole
    texts are read; null and empty texts hold nothing.  A text with several notices gives a row
    for each; repeated rows give theirs again, rows without doc_id give them with a null id; an
    empty table gives an empty result; other columns are not read.
    """
    known = prepared(TEMPLATES if templates is None else templates)

    def run(batches):
        for batch in batches:
            column = batch.column(1)
            sizes = np.array(pc.fill_null(pc.binary_length(column), 0))
            for i, j in slices(sizes, SLICE_BYTES):
                part = column.slice(i, j - i)
                rows = list(found_in(known, part, coverage, density))
                if rows:
                    text, *rest = zip(*sorted(rows))
                    ids = batch.column(0).slice(i, j - i).take(pa.array(text, pa.int64()))
                    names = ["doc_id", "license", "coverage", "start", "end", "words"]
                    yield pa.RecordBatch.from_arrays([ids, *map(pa.array, rest)], names=names)

    texts = documents.select(F.col("doc_id").cast("long"), F.col("text").cast("string"))
    schema = "doc_id long, license string, coverage double, start long, end long, words long"
    return texts.mapInArrow(run, schema)
