"""License scans: winnowed fingerprints of templates pick candidates, banded alignment reports coverage and spans."""

from __future__ import annotations

from collections.abc import Callable, Iterator, Mapping

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from patrimonia.llm import words as W

#: Public wording of license notices.
TEMPLATES: Mapping[str, str] = {
    "apache-2.0-line": "Licensed under the Apache License, Version 2.0",
    "apache-2.0-notice": (
        "you may not use this file except in compliance with the License. You may obtain a copy of the License at "
        "http://www.apache.org/licenses/LICENSE-2.0 Unless required by applicable law or agreed to in writing, software "
        'distributed under the License is distributed on an "AS IS" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, '
        "either express or implied. See the License for the specific language governing permissions and limitations under the License."
    ),
    "cc-by-nc-4.0-line": "Licensed under CC BY-NC 4.0",
    "cc-by-4.0-line": "This work is licensed under a Creative Commons Attribution 4.0 International License",
    "gpl-3.0-line": "This work is licensed under the GNU General Public License, version 3",
    "gpl-notice": (
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License "
        "as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version."
    ),
    "mit-line": "Released under the MIT License",
    "mit-permission": (
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation "
        'files (the "Software"), to deal in the Software without restriction, including without limitation the rights to use, copy, '
        "modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software "
        "is furnished to do so, subject to the following conditions:"
    ),
    "bsd-redistribution": (
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following "
        "conditions are met:"
    ),
}
GRAM, WINDOW = 2, 3
_EMPTY = np.zeros(0, np.int64)


def grams(word: np.ndarray, at: np.ndarray, gram: int) -> np.ndarray:
    """A hash for each word position; runs that go beyond a text's end get the largest value."""
    out = np.full(len(word), np.uint64(2**64 - 1))
    size = len(word) - gram + 1
    if size > 0:
        value = np.zeros(size, np.uint64)
        for j in range(gram):
            value += word[j : size + j] * W._PLACE[j]
        end = np.repeat(at[1:], np.diff(at))
        inside = np.arange(size) + gram <= end[:size]
        out[:size][inside] = W.mix(value[inside], 900 + gram)
    return out


def winnow(value: np.ndarray, at: np.ndarray, window: int) -> np.ndarray:
    """Positions that hold the least value of some full window (the last of equals); all of a text shorter than a window."""
    n = len(value)
    if n < window:
        return np.arange(n)
    least = value[: n - window + 1].copy()
    where = np.arange(n - window + 1)
    for j in range(1, window):
        other = value[j : n - window + 1 + j]
        lower = other <= least
        least[lower] = other[lower]
        where[lower] = np.flatnonzero(lower) + j
    end = np.repeat(at[1:], np.diff(at))
    chosen = np.zeros(n, bool)
    chosen[where[np.arange(n - window + 1) + window <= end[: n - window + 1]]] = True
    for i in np.flatnonzero((np.diff(at) < window + 1) & (np.diff(at) > 0)):
        chosen[at[i] : at[i + 1]] = True
    return np.flatnonzero(chosen)


def align(template: np.ndarray, text: np.ndarray, band: int) -> tuple[int, int, int]:
    """(matched words, first, last + 1) of the best local alignment: a match adds 2, a word left out or changed costs 1.

    Cell (i, j) lies in the band when |j - i - band| <= band: ``text`` begins ``band`` words before the diagonal.
    """
    n, width = len(template), 2 * band + 1
    score = np.zeros((n + 1, width + 1), np.int64)
    step = np.zeros((n + 1, width + 1), np.int8)  # 0 stop, 1 both, 2 template only, 3 text only
    best, at = 0, (0, 0)
    for i in range(1, n + 1):
        for d in range(width):
            j = i - 1 + d
            if j >= len(text):
                break
            both = score[i - 1, d] + (2 if template[i - 1] == text[j] else -1)
            skip_template = score[i - 1, d + 1] - 1 if d + 1 < width else -1
            skip_text = score[i, d - 1] - 1 if d else -1
            top = max(0, both, skip_template, skip_text)
            score[i, d] = top
            step[i, d] = 0 if not top else 1 if top == both else 2 if top == skip_template else 3
            if top > best:
                best, at = top, (i, d)
    i, d = at
    matched, last, first = 0, i - 1 + d + 1, i - 1 + d + 1
    while best and step[i, d]:
        kind = step[i, d]
        if kind == 1:
            j = i - 1 + d
            if template[i - 1] == text[j]:
                matched += 1
                first = j
            i -= 1
        elif kind == 2:
            i, d = i - 1, d + 1
        else:
            d -= 1
    return matched, first, last


class Index:
    """Inverted index from the templates' fingerprints to (template, position).

    Fingerprints are winnowed runs of ``gram`` words. Where the words that ``coverage`` allows to change, and as many
    insertions as the band takes, could spoil all of a template's runs, its longest words are fingerprints by themselves:
    twice as many and one more than may change.
    """

    def __init__(self, templates: Mapping[str, str], coverage: float, band: int, gram: int = GRAM, window: int = WINDOW) -> None:
        self.names, self.gram = sorted(templates), gram
        texts = [templates[n] for n in self.names]
        raw, offsets = W.text_bytes(pa.array(texts, pa.string()))
        self.word, begin, end, self.at = W.words(raw, offsets, W.NON_ALNUM)
        size = np.diff(self.at)
        self.bands = np.maximum(1, np.minimum(band, size // 4))  # far below the distance of two places of a template
        value = grams(self.word, self.at, gram)
        place = winnow(value, self.at, window)
        place = place[value[place] < np.uint64(2**64 - 1)]
        owner = np.searchsorted(self.at, place, "right") - 1
        changed = np.floor(np.round((1 - coverage) * size, 9)).astype(np.int64)
        #: Fingerprints of each template that must be met: a changed word spoils as many runs as a run has words at most.
        self.needed = np.bincount(owner, minlength=len(size)) - gram * changed - (gram - 1) * self.bands
        by_word = self.needed < 1
        self.runs = self._filed(value[place][~by_word[owner]], place[~by_word[owner]])
        chosen = [_EMPTY]
        for t in np.flatnonzero(by_word):
            own = np.arange(self.at[t], self.at[t + 1])
            longest = own[np.lexsort((own, begin[own] - end[own]))][: 2 * changed[t] + 1]
            self.needed[t] = len(longest) - changed[t]
            chosen.append(longest)
        chosen = np.concatenate(chosen)
        self.words = self._filed(self.word[chosen], chosen)

    def _filed(self, value: np.ndarray, place: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        order = np.argsort(value, kind="stable")
        maybe = np.zeros(1 << 16, bool)
        maybe[(value >> np.uint64(48)).astype(np.int64)] = True
        return value[order], place[order], maybe

    def template(self, number: int) -> np.ndarray:
        return self.word[self.at[number] : self.at[number + 1]]

    def hits(self, word: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(template, template position, text position) for each shared fingerprint of texts of ``word``."""
        found = [self._hits(filed, value) for filed, value in ((self.runs, grams(word, at, self.gram)), (self.words, word)) if len(filed[0])]
        place, where = (np.concatenate([_EMPTY, *(f[i] for f in found)]) for i in (0, 1))
        owner = np.searchsorted(self.at, place, "right") - 1
        return owner, place - self.at[owner], where

    @staticmethod
    def _hits(filed: tuple[np.ndarray, np.ndarray, np.ndarray], value: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        known, place, maybe = filed
        position = np.flatnonzero(maybe[(value >> np.uint64(48)).astype(np.int64)])
        value = value[position]
        low, high = np.searchsorted(known, value), np.searchsorted(known, value, "right")
        some = high > low
        low, many, position = low[some], (high - low)[some], position[some]
        at = np.repeat(low - (np.cumsum(many) - many), many) + np.arange(many.sum())
        return place[at], np.repeat(position, many)


def _centres(row: np.ndarray, template: np.ndarray, diagonal: np.ndarray, needed: np.ndarray, bands: np.ndarray) -> list[int]:
    """Hits, sorted by row, template and diagonal, around whose diagonal enough others lie: the fullest within each band."""
    group = np.cumsum(np.concatenate([[0], (np.diff(row) != 0) | (np.diff(template) != 0)]))
    place = group * (1 << 32) + diagonal
    first = np.flatnonzero(np.concatenate([[True], np.diff(place) != 0]))
    own = np.diff(np.append(first, len(place)))
    reach = bands[template[first]]
    near = np.searchsorted(place, place[first] + reach, "right") - np.searchsorted(place, place[first] - reach)
    enough = np.flatnonzero(near >= needed[template[first]])
    # the fullest first; what lies within its reach (which is the same in a group) is taken with it
    free = np.zeros(len(first), bool)
    free[enough] = True
    lo, hi = np.searchsorted(place[first], place[first] - reach), np.searchsorted(place[first], place[first] + reach, "right")
    chosen = []
    for k in enough[np.lexsort((enough, -own[enough]))].tolist():
        if free[k]:
            chosen.append(int(first[k]))
            free[lo[k] : hi[k]] = False
    return sorted(chosen)


def _scan(index: Index, coverage: float) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part, raw, at in W.chunks(batch):
                word, start, end, first = W.words(raw, at, W.NON_ALNUM)
                template, inside, where = index.hits(word, first)
                if not len(template):
                    continue
                row = np.searchsorted(first, where, "right") - 1
                order = np.lexsort((where - inside, template, row))
                row, template, diagonal = row[order], template[order], (where - inside)[order]
                chars = np.concatenate([[0], np.cumsum((raw & 0xC0) != 0x80)])  # code points before each byte
                found = []
                for i in _centres(row, template, diagonal, index.needed, index.bands):
                    band = index.bands[template[i]]
                    own = index.template(template[i])
                    lo = max(first[row[i]], diagonal[i] - band)
                    hi = min(first[row[i] + 1], diagonal[i] + len(own) + band + 1)
                    if np.isin(own, word[lo:hi]).sum() < coverage * len(own) - 1e-9:
                        continue  # words that aren't there can't be aligned
                    head = np.zeros(max(0, lo - (diagonal[i] - band)), np.uint64)  # before the text's begin: no word
                    matched, a, b = align(own, np.concatenate([head, word[lo:hi]]), band)
                    if matched >= coverage * len(own) - 1e-9:
                        a, b = lo + max(0, a - len(head)), lo + b - len(head)
                        zero = chars[at[row[i]]]
                        found.append((row[i], index.names[template[i]], matched, matched / len(own), int(chars[start[a]] - zero), int(chars[end[b - 1]] - zero)))
                found = list({(x[0], x[1], x[4], x[5]): x for x in found}.values())
                if found:
                    rows, names, matched, share, begin, stop = zip(*found, strict=True)
                    yield pa.record_batch(
                        [part.column(0).take(pa.array(np.array(rows))), pa.array(names), pa.array(matched, pa.int64()), pa.array(share, pa.float64()), pa.array(begin, pa.int64()), pa.array(stop, pa.int64())],
                        ["doc_id", "license", "n_matched", "coverage", "begin", "end"],
                    )

    return run


def license_spans(docs: DataFrame, templates: Mapping[str, str] = TEMPLATES, coverage: float = 0.8, band: int = 8) -> DataFrame:
    """(doc_id, license, n_matched, coverage, begin, end): passages of ``docs(doc_id, text)`` that hold a template.

    Words are runs of ASCII letters (A-Z lower-cased), digits and non-ASCII characters. A passage counts if the
    best banded alignment matches ``coverage`` of the template's words in order; begin and end (exclusive) are
    code points. A text that holds a template several times gives a row for each place, and passages that fit
    several templates one for each. Null, empty and wordless texts give none; nor do rows with a null doc_id.
    Repeated rows give their passages each. Other columns play no part. Without templates the result is empty.

    The index holds the templates' winnowed runs of GRAM words, one for each WINDOW at least, or single words where
    edits could spoil all runs; texts look all their runs and words up. A template is a candidate where as many of its
    fingerprints are met, within a band of places, as remain when the share of its words that coverage allows to miss is
    changed and as many words as the band takes are put in.
    """
    text = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")).where("doc_id is not null and text is not null")
    index = Index({k: v for k, v in templates.items() if v and v.strip()}, coverage, band)
    return text.mapInArrow(_scan(index, coverage), "doc_id long, license string, n_matched long, coverage double, begin long, end long")
