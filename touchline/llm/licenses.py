"""License scan: fingerprints pick candidates, banded alignment confirms them.

Templates are split into lower-case words of letters and digits. Their fingerprints are hashes of runs of q words,
winnowed: of each w runs in a row the least hash stays, the last of equal ones. An inverted index gives the places of
each fingerprint in the templates. It is small (the templates' size is checked) and goes to every task. A text's runs are looked up in the index; hits of one template on nearby diagonals form a candidate, and the
words around them are aligned with the template in a band of diagonals (match +2, mismatch and gap -1, local in the
text and in the template). A finding is an alignment that covers at least ``coverage`` of the template's words;
overlapping findings of one template keep the best.

Of a template's n words e = floor((1 - coverage) * n) may be edited. The other n - e lie in e + 1 stretches, one of which
has l = (n - e) / (e + 1) words at least, rounded up. q + w - 1 = l, with q at most ``GRAM`` and, from three words on, below
l, so each stretch of l words holds a fingerprint. The stretches have n - e - (e + 1) * (l - 1) windows of w runs at least;
a fingerprint stands for w of them at most. A candidate needs so many hits, on diagonals within e of each other, which its
band covers. So no text with up to e words changed, left out or put in is missed before the alignment.

The scan reads each text once, in the scan's stage, and shuffles nothing.

Defined results: null and empty texts have no findings; a template that occurs several times is reported each time;
different templates may overlap; repeated rows are scanned each; null ids stay; other columns are ignored; an empty
table or an empty set of templates gives no rows; a template of less than four words is an error.
"""

from __future__ import annotations

from collections.abc import Iterator, Mapping

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from touchline.llm.common import SPLIT_ALNUM, Hasher, chunks_of, rolling, runs_inside

GRAM = 4
COVERAGE = 0.75
TEMPLATE_BYTES = 16 << 20

# Notices and texts of common licenses.
TEMPLATES = {
    "mit-notice": "Released under the MIT License.",
    "apache-2.0-notice": "Licensed under the Apache License, Version 2.0.",
    "gpl-3.0-notice": "This work is licensed under the GNU General Public License, version 3.",
    "cc-by-nc-4.0-notice": "Licensed under CC BY-NC 4.0.",
    "cc-by-4.0-notice": "This work is licensed under a Creative Commons Attribution 4.0 International License.",
    "mit": (
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated "
        'documentation files (the "Software"), to deal in the Software without restriction, including without limitation '
        "the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and "
        "to permit persons to whom the Software is furnished to do so, subject to the following conditions: The above "
        "copyright notice and this permission notice shall be included in all copies or substantial portions of the "
        "Software."
    ),
    "apache-2.0-header": (
        'Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in compliance '
        "with the License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0 Unless "
        "required by applicable law or agreed to in writing, software distributed under the License is distributed on an "
        '"AS IS" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied. See the License for the '
        "specific language governing permissions and limitations under the License."
    ),
    "gpl-3.0-header": (
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public "
        "License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any "
        "later version. This program is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; without "
        "even the implied warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE."
    ),
    "bsd-2-clause": (
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the "
        "following conditions are met: 1. Redistributions of source code must retain the above copyright notice, this list "
        "of conditions and the following disclaimer. 2. Redistributions in binary form must reproduce the above copyright "
        "notice, this list of conditions and the following disclaimer in the documentation and/or other materials provided "
        "with the distribution."
    ),
    "bsd-3-clause-endorsement": (
        "Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote "
        "products derived from this software without specific prior written permission."
    ),
    "isc": (
        "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby "
        "granted, provided that the above copyright notice and this permission notice appear in all copies."
    ),
    "mpl-2.0-header": (
        "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was not "
        "distributed with this file, You can obtain one at https://mozilla.org/MPL/2.0/."
    ),
}


def winnow(hashes: np.ndarray, window: int) -> np.ndarray:
    """The places of the least hash of each ``window`` hashes in a row, the last of equal ones; one place if there are fewer."""
    if not len(hashes):
        return np.zeros(0, np.int64)
    views = np.lib.stride_tricks.sliding_window_view(hashes, min(window, len(hashes)))
    return np.unique(np.arange(len(views)) + views.shape[1] - 1 - views[:, ::-1].argmin(axis=1))


class Index:
    """The templates' words, and the places of each fingerprint by its number of words."""

    def __init__(self, templates: Mapping[str, str], coverage: float):
        if sum(len(t.encode()) for t in templates.values()) > TEMPLATE_BYTES:
            raise ValueError(f"templates above {TEMPLATE_BYTES} bytes; scan them in several runs")
        self.names = sorted(templates)
        words = Hasher(SPLIT_ALNUM).words([templates[n].encode() for n in self.names])
        self.words = [words.hashes[a:b] for a, b in zip(words.first[:-1], words.first[1:], strict=True)]
        if short := [n for n, own in zip(self.names, self.words, strict=True) if len(own) < GRAM]:
            raise ValueError(f"templates below {GRAM} words have no fingerprint: {short}")
        self.edits = [max(0, int((1 - coverage) * len(own) + 1e-9)) for own in self.words]
        self.least, places = [], {}
        for t, (own, e) in enumerate(zip(self.words, self.edits, strict=True)):
            whole = -(-(len(own) - e) // (e + 1))  # some stretch without an edit has so many words
            q = min(GRAM, max(whole - 1, min(whole, 2)))
            window = whole - q + 1
            self.least.append(-(-(len(own) - e - (e + 1) * (whole - 1)) // window))
            grams = rolling(own, q)
            places.setdefault(q, []).extend((int(grams[p]), t, p) for p in winnow(grams, window).tolist())
        self.runs = {}
        for q, rows in sorted(places.items()):
            rows.sort()
            self.runs[q] = tuple(np.array([r[i] for r in rows], kind) for i, kind in enumerate((np.uint64, np.int64, np.int64)))

    def hits(self, words: np.ndarray, first: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(place in the words, template, place in the template) of all runs inside a text that are fingerprints."""
        found = [(np.zeros(0, np.int64),) * 3]
        for q, (hashes, template, place) in self.runs.items():
            inside = np.flatnonzero(runs_inside(first, q, len(words)))
            grams = rolling(words, q)[inside]
            low, high = np.searchsorted(hashes, grams, "left"), np.searchsorted(hashes, grams, "right")
            at = np.flatnonzero(high > low)
            count = (high - low)[at]
            entry = np.repeat(low[at] - (np.cumsum(count) - count), count) + np.arange(count.sum())
            found.append((np.repeat(inside[at], count), template[entry], place[entry]))
        return tuple(np.concatenate(x) for x in zip(*found, strict=True))


def align(text: np.ndarray, template: np.ndarray, diagonal: int, band: int) -> tuple[int, int, int, int] | None:
    """Best local alignment within ``band`` of a diagonal (text place - template place).

    (score, words matched, first text word, after the last), None without a match; the first of equal ends counts.
    """
    best, rows, n = (0, 0, 0, 0), {}, len(text)
    for j, word in enumerate(template.tolist()):
        new = {}
        for i in range(max(0, j + diagonal - band), min(n, j + diagonal + band + 1)):
            same = int(text[i]) == word
            score, matched, start = rows.get(i - 1, (0, 0, i))
            cells = [(score + (2 if same else -1), matched + same, start if score > 0 else i)]
            if i in rows:
                score, matched, start = rows[i]
                cells.append((score - 1, matched, start))
            if i - 1 in new:
                score, matched, start = new[i - 1]
                cells.append((score - 1, matched, start))
            cell = max(cells, key=lambda c: (c[0], c[1]))
            if cell[0] > 0:
                new[i] = cell
                if cell[0] > best[0]:
                    best = (cell[0], cell[1], cell[2], i + 1)
        rows = new
    return best if best[0] > 0 else None


def candidates(places: np.ndarray, own: np.ndarray, band: int) -> list[int]:
    """Middle diagonals of groups of hits whose diagonals are within ``band`` of each other."""
    diagonals = np.unique(places - own)
    groups = np.split(diagonals, np.flatnonzero(np.diff(diagonals) > band) + 1)
    out = []
    for g in groups:  # a long chain of diagonals is cut into bands
        for low in range(int(g[0]), int(g[-1]) + 1, 2 * band + 1):
            inside = g[(g >= low) & (g <= low + 2 * band)]
            if len(inside):
                out.append(int(inside[0] + inside[-1]) // 2)
    return out


def find(words: np.ndarray, hits: tuple[np.ndarray, np.ndarray, np.ndarray], index: Index, coverage: float) -> list[tuple]:
    """(template, start, end, matched, coverage) of a text's findings, by start and name."""
    found = []
    for t in np.unique(hits[1]).tolist():
        template, mine = index.words[t], hits[1] == t
        band = 2 + len(template) // 8
        wide, aligned = max(2 * band, band + 1 + index.edits[t]), []
        diagonals = np.sort(hits[0][mine] - hits[2][mine])
        for diagonal in candidates(hits[0][mine], hits[2][mine], band):
            around = np.searchsorted(diagonals, [diagonal - wide, diagonal + wide + 1])
            if around[1] - around[0] < index.least[t]:
                continue
            low = max(0, diagonal - wide)
            part = words[low : max(low, diagonal + len(template) + wide)]
            best = align(part, template, diagonal - low, wide)
            if best and best[1] >= coverage * len(template):
                aligned.append((best[0], best[1], best[2] + low, best[3] + low))
        taken: list[tuple[int, int]] = []
        for _, matched, start, end in sorted(aligned, key=lambda a: (-a[0], a[2])):
            if all(end <= a or start >= b for a, b in taken):
                taken.append((start, end))
                found.append((index.names[t], start, end, matched, matched / len(template)))
    return sorted(found, key=lambda f: (f[1], f[0]))


def scan_licenses(
    docs: DataFrame, templates: Mapping[str, str] = TEMPLATES, key: str = "doc_id", text: str = "text", coverage: float = COVERAGE
) -> DataFrame:
    """One row per finding: key, license, start_word, end_word (exclusive), matched words, coverage."""
    index = Index(templates, coverage)
    kind = docs.schema[key].dataType.simpleString()

    def scan(batches: Iterator[pa.RecordBatch]):
        hasher = Hasher(SPLIT_ALNUM)
        for batch in batches:
            keys, texts = batch.column(0), [t or b"" for t in batch.column(1).to_pylist()]
            out = []
            for a, b in chunks_of(texts):
                words = hasher.words(texts[a:b])
                places, which, own = index.hits(words.hashes, words.first)
                owner = np.searchsorted(words.first, places, side="right") - 1
                for d in np.unique(owner).tolist():
                    mine = owner == d
                    begin, end = int(words.first[d]), int(words.first[d + 1])
                    hits = places[mine] - begin, which[mine], own[mine]
                    out += [(a + d, *f) for f in find(words.hashes[begin:end], hits, index, coverage)]
            if out:
                rows = list(zip(*out, strict=True))
                columns = [keys.take(pa.array(rows[0])), pa.array(rows[1])]
                columns += [pa.array(rows[i], pa.int64()) for i in (2, 3, 4)] + [pa.array(rows[5], pa.float64())]
                yield pa.RecordBatch.from_arrays(columns, names=["key", "license", "start_word", "end_word", "matched", "coverage"])

    given = docs.select(F.col(key).alias("key"), F.col(text).cast("binary").alias("text"))
    found = given.mapInArrow(scan, f"key {kind}, license string, start_word bigint, end_word bigint, matched bigint, coverage double")
    return found.withColumnRenamed("key", key)


def op2_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scan_licenses(spark.read.parquet(f"{sf_dir}/documents.parquet"))
