"""License scans by patience alignment.

A text is searched for windows that may hold a template: words that occur once in the template and are not everyday words vote for it, and
votes within its reach of each other make a window. Window and template are then aligned by patience: words that occur once in
both are anchors, the longest increasing subsequence of them is kept, and the gaps between are aligned the same way. Where that doesn't give a
lone copy held whole, the longest common subsequences of all spans of the window are taken. The share of the
template's words so matched is its coverage; enough of it is a find, with the span from the first to the last matched word.
"""

from __future__ import annotations

import re
from bisect import bisect_left
from collections import Counter
from collections.abc import Iterator
from math import ceil

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .shared import batched

WORD = re.compile(r"[^\W_]+(?:[-.'][^\W_]+)*")
#: Words that occur in any prose and so don't vote for where a template begins.
EVERYDAY = frozenset("a above all an and any are as at be by for from have if in is it its may not of on or shall so such that the these this to under use was which will with you your".split())

#: Two neighbouring votes of one place are at most the template's length and so many words apart.
REACH = 8

MIT = """Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the "Software"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the following conditions: The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software."""
ISC = """Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the above copyright notice and this permission notice appear in all copies."""
BSD2 = """Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met: 1. Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer. 2. Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer in the documentation and/or other materials provided with the distribution."""
BSD3 = BSD2 + """ 3. Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from this software without specific prior written permission."""
APACHE = """Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in compliance with the License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0 Unless required by applicable law or agreed to in writing, software distributed under the License is distributed on an "AS IS" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied."""
GPL3 = """This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version. This program is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; without even the implied warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE."""
#: Public license texts, headers and one-line notices, by name.
TEMPLATES: dict[str, str] = {
    "MIT": MIT,
    "ISC": ISC,
    "BSD-2-Clause": BSD2,
    "BSD-3-Clause": BSD3,
    "Apache-2.0": APACHE,
    "GPL-3.0": GPL3,
    "MIT-notice": "Released under the MIT License.",
    "Apache-2.0-notice": "Licensed under the Apache License, Version 2.0.",
    "GPL-3.0-notice": "This work is licensed under the GNU General Public License, version 3.",
    "CC-BY-NC-4.0-notice": "Licensed under CC BY-NC 4.0.",
    "CC-BY-4.0-notice": "This work is licensed under a Creative Commons Attribution 4.0 International License.",
}


def tokens(text: str) -> list[str]:
    return [w.lower() for w in WORD.findall(text)]


def rising(values: list[int]) -> list[int]:
    """Places of a longest strictly increasing subsequence."""
    tails: list[int] = []
    at: list[int] = []
    back: list[int] = []
    for i, v in enumerate(values):
        k = bisect_left(tails, v)
        back.append(at[k - 1] if k else -1)
        if k == len(tails):
            tails.append(v)
            at.append(i)
        else:
            tails[k], at[k] = v, i
    out, i = [], at[-1] if at else -1
    while i >= 0:
        out.append(i)
        i = back[i]
    return out[::-1]


def patience(a: list[str], b: list[str]) -> list[tuple[int, int]]:
    """Matched places of a and b, rising in both: equal heads and tails, anchors unique to both between them, and so on in the gaps."""
    out: list[tuple[int, int]] = []
    todo = [(0, len(a), 0, len(b))]
    while todo:
        a0, a1, b0, b1 = todo.pop()
        while a0 < a1 and b0 < b1 and a[a0] == b[b0]:
            out.append((a0, b0))
            a0, b0 = a0 + 1, b0 + 1
        while a0 < a1 and b0 < b1 and a[a1 - 1] == b[b1 - 1]:
            a1, b1 = a1 - 1, b1 - 1
            out.append((a1, b1))
        if a0 == a1 or b0 == b1:
            continue
        in_a, in_b = Counter(a[a0:a1]), Counter(b[b0:b1])
        place = {w: j for j, w in enumerate(b[b0:b1], b0) if in_b[w] == 1}
        anchors = [(i, place[w]) for i, w in enumerate(a[a0:a1], a0) if in_a[w] == 1 and w in place]
        kept = [anchors[x] for x in rising([j for _, j in anchors])]
        out += kept
        last_a, last_b = a0, b0
        for i, j in kept:
            todo.append((last_a, i, last_b, j))
            last_a, last_b = i + 1, j + 1
        if kept:
            todo.append((last_a, a1, last_b, b1))
    return sorted(out)


class Template:
    def __init__(self, name: str, text: str, coverage: float):
        self.name, self.words = name, tokens(text)
        #: So many words in order are a find.
        self.least = max(1, ceil(coverage * len(self.words) - 1e-9))
        self.reach = len(self.words) + REACH
        self.places: dict[str, list[int]] = {}
        for j in range(len(self.words) - 1, -1, -1):
            self.places.setdefault(self.words[j], []).append(j)
        own = {w for w, at in self.places.items() if len(at) == 1 and w not in EVERYDAY}
        if not own:
            raise ValueError(f"{name} has no word of its own")
        missing = len(self.words) - self.least
        # A find may lack every word of its own where these are few: then all words vote.
        self.votes = own if len(own) > missing else set(self.places)
        #: A find lacks `missing` words at most, so it holds so many of the voting words.
        self.need = max(1, len(own) - missing)


def spans(words: list[str], t: Template) -> list[tuple[int, int, int]]:
    """(matched, from, to): for each place where one ends, the shortest span with so many template words in order, for each number from t.least on."""
    n = len(t.words)
    # start[j, m]: the last place from which m of the template's first j words follow in order, up to the word looked at.
    start = np.full((n + 1, n + 1), -1, np.int64)
    out = []
    for i, w in enumerate(words):
        at = t.places.get(w)
        if at is None:
            continue
        before = start[n, t.least :].copy()
        for j in at:  # from the last on, so that a word counts once
            longer = start[j, :-1].copy()
            longer[0] = i
            np.maximum(start[j + 1 :, 1:], longer, out=start[j + 1 :, 1:])
        now = start[n, t.least :]
        out += [(int(m) + t.least, int(now[m]), i) for m in np.flatnonzero(now > before)]
    return out


class Finder:
    def __init__(self, templates: dict[str, str], coverage: float):
        self.templates = [Template(n, t, coverage) for n, t in templates.items()]
        self.seeds: dict[str, list[int]] = {}
        for k, t in enumerate(self.templates):
            for w in t.votes:
                self.seeds.setdefault(w, []).append(k)

    def windows(self, words: list[str]) -> Iterator[tuple[int, int, int]]:
        """(template, from, to): runs of votes no further apart than the template's reach, with so much more on either side, that hold enough different votes."""
        votes: dict[int, list[int]] = {}
        for i, w in enumerate(words):
            for k in self.seeds.get(w, ()):
                votes.setdefault(k, []).append(i)
        for k, cast in votes.items():
            t, first = self.templates[k], 0
            for x in range(1, len(cast) + 1):
                if x == len(cast) or cast[x] - cast[x - 1] > t.reach:
                    if x - first >= t.need and len({words[i] for i in cast[first:x]}) >= t.need:
                        yield k, max(0, cast[first] - t.reach), min(len(words), cast[x - 1] + t.reach + 1)
                    first = x

    def places(self, words: list[str], k: int) -> list[tuple[int, int, int]]:
        """(matched, from, to) of a window: a lone copy held whole by patience, anything else by spans()."""
        t = self.templates[k]
        counts = Counter(w for w in words if w in t.votes)
        if sum((Counter(words) & Counter(t.words)).values()) < t.least:
            return []
        if len(counts) == len(t.votes) == sum(counts.values()):
            pairs = patience(words, t.words)
            if len(pairs) == len(t.words) == pairs[-1][0] - pairs[0][0] + 1:
                return [(len(pairs), pairs[0][0], pairs[-1][0])]
        return spans(words, t)

    def find(self, text: str) -> list[tuple[int, int, str, int, int]]:
        """(start, end, name, matched words, template's words) by start: spans in code points; of overlapping finds that with most matched words stays."""
        if self.seeds.keys().isdisjoint(WORD.findall(text.lower())):
            return []
        places = [(m.start(), m.end()) for m in WORD.finditer(text)]
        words = [text[a:b].lower() for a, b in places]
        found = []
        for k, low, high in self.windows(words):
            for n, first, last in self.places(words[low:high], k):
                found.append((n, n / len(self.templates[k].words), places[low + first][0], places[low + last][1], k))
        found.sort(key=lambda f: (-f[0], -f[1], f[2], f[4]))
        kept: list[tuple[int, int, str, int, int]] = []
        for n, _, start, end, k in found:
            if all(end <= a or b <= start for a, b, *_ in kept):
                kept.append((start, end, self.templates[k].name, n, len(self.templates[k].words)))
        return sorted(kept)


FOUND = pa.schema([("doc_id", pa.int64()), ("license", pa.string()), ("start", pa.int64()), ("end", pa.int64()), ("n_matched", pa.int64()), ("n_template", pa.int64())])


def scanner(templates: dict[str, str], coverage: float):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        finder = Finder(templates, coverage)

        def made():
            for batch in batches:
                for doc, text in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                    for start, end, name, n, of in finder.find(text.as_py() or ""):
                        yield doc, name, start, end, n, of

        yield from batched(made(), FOUND)

    return run


def licenses(docs: DataFrame, templates: dict[str, str] | None = None, coverage: float = 0.8) -> DataFrame:
    """(doc_id, license, start, end, n_matched, n_template): every place in a text that holds at least `coverage` of a template's words in order.

    A place ends where none of the template's own words comes for as many words as the template has and REACH more; up to there, foreign
    words may stand anywhere in it. Spans are code points, end exclusive. Places that overlap give the one with most matched words (then the higher coverage, the
    earlier start, the earlier template). A text without finds, empty or null gives no row; repeated rows give theirs each; a null doc_id
    stays null; extra columns are ignored. Texts are read once and nothing is shuffled.
    """
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return texts.mapInArrow(scanner(templates or TEMPLATES, coverage), "doc_id long, license string, start long, end long, n_matched long, n_template long")
