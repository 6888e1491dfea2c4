"""License scan: winnowed template fingerprints in an inverted index pick candidates, banded alignment confirms them."""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Mapping
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from shelfmark.llm.common import Batches, on_executors, texts

# Notices and permission texts as they are published.
TEMPLATES = {
    "MIT": (
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated "
        "documentation files (the \"Software\"), to deal in the Software without restriction, including without limitation "
        "the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to "
        "permit persons to whom the Software is furnished to do so, subject to the following conditions: The above copyright "
        "notice and this permission notice shall be included in all copies or substantial portions of the Software."
    ),
    "MIT-notice": "Released under the MIT License.",
    "Apache-2.0": (
        "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in compliance "
        "with the License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0 Unless required "
        "by applicable law or agreed to in writing, software distributed under the License is distributed on an \"AS IS\" "
        "BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied."
    ),
    "Apache-2.0-notice": "Licensed under the Apache License, Version 2.0.",
    "GPL-3.0": (
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public "
        "License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later "
        "version. This program is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; without even the "
        "implied warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE."
    ),
    "GPL-3.0-notice": "This work is licensed under the GNU General Public License, version 3.",
    "CC-BY-NC-4.0-notice": "Licensed under CC BY-NC 4.0.",
    "CC-BY-4.0": "This work is licensed under a Creative Commons Attribution 4.0 International License.",
    "BSD-2-Clause": (
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the "
        "following conditions are met: Redistributions of source code must retain the above copyright notice, this list of "
        "conditions and the following disclaimer. Redistributions in binary form must reproduce the above copyright notice, "
        "this list of conditions and the following disclaimer in the documentation and/or other materials provided with the "
        "distribution."
    ),
}
#: Words of a shingle, and shingles of a window of which the least hash is indexed.
SHINGLE = 3
WINDOW = 3
#: Share of a template's words that must be matched, in order, and half the band's width as a share of its words.
COVERAGE = 0.8
BAND = 0.15
STEP = 1 << 19
BASE = 0x9E3779B97F4A7C15


@cache
def _bytes() -> tuple[np.ndarray, np.ndarray]:
    """Each byte lower-cased, and whether it is part of a word."""
    lower, word = np.arange(256, dtype=np.uint64) + np.uint64(1), np.zeros(256, bool)
    lower[65:91] += np.uint64(32)
    word[0x80:] = True
    word[[b for b in range(0x80) if chr(b).isalnum()]] = True
    return lower, word


@cache
def _powers(n: int) -> np.ndarray:
    out = np.ones((2, n), np.uint64)
    out[0, 1:] = BASE
    out[1, 1:] = pow(BASE, -1, 1 << 64)
    return np.multiply.accumulate(out, 1)


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def words(data: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts, ends and hashes of the words, ASCII letters lower-cased."""
    lower, word = _bytes()
    inside = np.zeros(len(data) + 2, np.int8)
    inside[1:-1] = word[data]
    edges = np.diff(inside)
    starts, ends = np.flatnonzero(edges == 1), np.flatnonzero(edges == -1)
    ahead, back = _powers(1 << max(10, int(len(data)).bit_length()))
    sums = np.zeros(len(data) + 1, np.uint64)
    np.cumsum(lower[data] * ahead[: len(data)], out=sums[1:])
    return starts, ends, _mix((sums[ends] - sums[starts]) * back[starts])


def shingles(hashes: np.ndarray) -> np.ndarray:
    out = hashes[: max(0, len(hashes) - SHINGLE + 1)]
    for i in range(1, SHINGLE):
        out = _mix(out * np.uint64(BASE) + hashes[i : len(hashes) - SHINGLE + 1 + i])
    return out


def winnow(values: np.ndarray) -> list[int]:
    """Places of the least of every WINDOW neighbours, the rightmost of equals."""
    width = min(WINDOW, len(values))
    return sorted({max(range(i, i + width), key=lambda j: (-int(values[j]), j)) for i in range(len(values) - width + 1)}) if width else []


class Index:
    """Template words, and the inverted index of their winnowed shingles."""

    def __init__(self, templates: Mapping[str, str]) -> None:
        self.names = list(templates)
        self.words = [words(np.frombuffer(t.encode(), np.uint8))[2] for t in templates.values()]
        listed = defaultdict(list)
        for t, hashes in enumerate(self.words):
            found = shingles(hashes)
            for place in winnow(found):
                listed[int(found[place])].append((t, place))
        self.places = dict(listed)
        self.keys = np.sort(np.array(list(listed), np.uint64))

    def hits(self, hashes: np.ndarray) -> np.ndarray:
        """Places of shingles that some template has."""
        found = shingles(hashes)
        if not len(self.keys) or not len(found):
            return np.zeros(0, np.int64)
        at = np.minimum(np.searchsorted(self.keys, found), len(self.keys) - 1)
        return np.flatnonzero(self.keys[at] == found)

    def band(self, template: int) -> int:
        return max(1, int(len(self.words[template]) * BAND))

    def candidates(self, hashes: np.ndarray, hits: np.ndarray) -> list[tuple[int, int, int]]:
        """(template, least and greatest word at which it would begin), one for each group of hits along a band."""
        found = shingles(hashes)
        begins = defaultdict(list)
        for i in hits.tolist():
            for t, place in self.places[int(found[i])]:
                begins[t].append(i - place)
        out = []
        for t, places in begins.items():
            first = last = None
            for begin in sorted(places):
                if first is not None and begin - first <= self.band(t):
                    last = begin
                    continue
                if first is not None:
                    out.append((t, first, last))
                first = last = begin
            out.append((t, first, last))
        return out

    def scan(self, data: np.ndarray) -> list[tuple[str, float, int, int, int]]:
        """(license, coverage, matched words, first byte, end byte) of the best matches that do not overlap."""
        starts, ends, hashes = words(data)
        hits = self.hits(hashes)
        found = []
        for t, first, last in self.candidates(hashes, hits) if len(hits) else []:
            matched = align(self.words[t], hashes, first - self.band(t), last + self.band(t))
            coverage = len(matched) / len(self.words[t])
            if coverage >= COVERAGE:
                found.append((coverage, len(matched), -t, int(starts[matched[0]]), int(ends[matched[-1]])))
        out: list[tuple] = []
        # More matched words first; a match may share up to half of its bytes with a better one.
        for coverage, n, t, start, end in sorted(found, key=lambda m: (-m[1], -m[0], -m[2], m[3])):
            if not any(2 * (min(end, e) - max(start, s)) > end - start for *_, s, e in out):
                out.append((self.names[-t], coverage, n, start, end))
        return sorted(out, key=lambda m: m[3:])


def align(template: np.ndarray, text: np.ndarray, first: int, last: int) -> list[int]:
    """Places in the text of a longest common subsequence with the template, whose word i may lie at first + i to last + i.

    Of equally long ones a tight one: the end is the earliest that reaches the full length.
    """
    width = last - first + 1
    score = np.zeros((len(template) + 1, width + 1), np.int32)
    for i, word in enumerate(template):
        at = np.arange(first + i, last + i + 1)
        valid = (at >= 0) & (at < len(text))
        same = np.zeros(width, bool)
        same[valid] = text[at[valid]] == word
        # Column c of row i + 1 stands for text up to at[c]; the row before is one word behind.
        row = np.maximum(np.r_[score[i, 1:], score[i, -1]][:width], score[i, :width] + same)
        score[i + 1, :width] = np.maximum.accumulate(row)
        score[i + 1, width] = score[i + 1, width - 1]
    out: list[int] = []
    i, c = len(template), int(np.argmax(score[-1, :width]))
    while i > 0 and c >= 0 and score[i, c] > 0:
        at = first + i - 1 + c
        if c > 0 and score[i, c - 1] == score[i, c]:
            c -= 1
        elif 0 <= at < len(text) and text[at] == template[i - 1] and score[i, c] == score[i - 1, c] + 1:
            out.append(at)
            i -= 1
        else:
            i, c = i - 1, c + 1
            c = min(c, width - 1)
    return out[::-1]


@cache
def _index(templates: tuple[tuple[str, str], ...]) -> Index:
    return Index(dict(templates))


FIELDS = [("license", pa.string()), ("coverage", pa.float64()), ("matched_words", pa.int64()), ("start", pa.int64()), ("end", pa.int64())]


def _found(index: Index, text: bytes) -> list[tuple]:
    """Matches in code points; long texts in pieces that overlap by more than any template's band."""
    data = np.frombuffer(text, np.uint8)
    reach = 64 * max((len(w) for w in index.words), default=0)
    found = set()
    for at in range(0, max(1, len(data) - reach), STEP):
        for name, coverage, n, start, end in index.scan(data[at : at + STEP + reach]):
            # What begins in the overlap is the next piece's, where there is one.
            if start < STEP or at + STEP >= len(data) - reach:
                found.add((name, coverage, n, at + start, at + end))
    if not found:
        return []
    letters = np.concatenate([[0], np.cumsum((data < 0x80) | (data >= 0xC0))])
    return [(name, c, n, int(letters[s]), int(letters[e])) for name, c, n, s, e in sorted(found, key=lambda m: m[3:])]


def scan(docs: DataFrame, templates: Mapping[str, str] | None = None) -> DataFrame:
    """(row, matches): a struct of the columns but text, and the license texts found.

    A match has license, coverage (share of the template's words found in order), matched_words, start and end (code points,
    exclusive). A null or empty text has none; repeated rows are scanned each. The templates are a parameter whose size does
    not depend on the data, so each task holds their index, and no text is shuffled.
    """
    listed = tuple((TEMPLATES if templates is None else templates).items())
    kind = pa.list_(pa.struct(FIELDS))

    def run(batches: Batches) -> Batches:
        index = _index(listed)
        names = [n for n, _ in FIELDS]
        for batch in batches:
            found = [[dict(zip(names, m)) for m in _found(index, t or b"")] for t in texts(batch)]
            yield pa.RecordBatch.from_arrays([batch.column("row"), pa.array(found, kind)], ["row", "matches"])

    rest = [F.col(f"`{c}`") for c in docs.columns if c != "text"]
    rows = docs.select(F.struct(*rest).alias("row"), F.col("text").cast("string").alias("text"))
    match = T._parse_datatype_string("array<struct<license:string,coverage:double,matched_words:long,start:long,end:long>>")
    schema = T.StructType([rows.schema["row"], T.StructField("matches", match)])
    return on_executors(rows, run, schema)


def report(docs: DataFrame) -> DataFrame:
    """One row per match: doc_id and the match."""
    found = scan(docs.select("doc_id", "text"))
    return found.select(F.col("row.doc_id").cast("long").alias("doc_id"), F.explode("matches").alias("match")).select("doc_id", "match.*")
