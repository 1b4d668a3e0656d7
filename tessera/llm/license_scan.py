"""License scans: patience alignment of whole texts with license notices, longest common subsequences where it falls short."""

from __future__ import annotations

import re
from bisect import bisect_left
from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import LOWER_AZ

WORD = re.compile(r"[^\W_]+")
_AS_IS = (
    "THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS \"AS IS\" AND ANY EXPRESS OR IMPLIED WARRANTIES, INCLUDING, BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND "
    "FITNESS FOR A PARTICULAR PURPOSE ARE DISCLAIMED. IN NO EVENT SHALL THE COPYRIGHT HOLDER OR CONTRIBUTORS BE LIABLE FOR ANY DIRECT, INDIRECT, INCIDENTAL, SPECIAL, EXEMPLARY, OR CONSEQUENTIAL DAMAGES "
    "(INCLUDING, BUT NOT LIMITED TO, PROCUREMENT OF SUBSTITUTE GOODS OR SERVICES; LOSS OF USE, DATA, OR PROFITS; OR BUSINESS INTERRUPTION) HOWEVER CAUSED AND ON ANY THEORY OF LIABILITY, WHETHER IN CONTRACT, "
    "STRICT LIABILITY, OR TORT (INCLUDING NEGLIGENCE OR OTHERWISE) ARISING IN ANY WAY OUT OF THE USE OF THIS SOFTWARE, EVEN IF ADVISED OF THE POSSIBILITY OF SUCH DAMAGE."
)
_BSD = (
    "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met: 1. Redistributions of source code must retain the above "
    "copyright notice, this list of conditions and the following disclaimer. 2. Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer "
    "in the documentation and/or other materials provided with the distribution. "
)
#: Notices and texts to look for: fixed values, the public wording of the licenses.
TEMPLATES = {
    "MIT": "Released under the MIT License.",
    "Apache-2.0": "Licensed under the Apache License, Version 2.0.",
    "GPL-3.0": "This work is licensed under the GNU General Public License, version 3.",
    "CC-BY-NC-4.0": "Licensed under CC BY-NC 4.0.",
    "CC-BY-4.0": "This work is licensed under a Creative Commons Attribution 4.0 International License.",
    "CC-BY-SA-4.0": "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License.",
    "BSD-conditions": "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met",
    "MPL-2.0": "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0.",
    "MIT-grant": "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files",
    "GPL-2.0-or-later": "This program is free software; you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation; either version 2 of the License, or (at your option) any later version.",
    "LGPL-2.1-or-later": "This library is free software; you can redistribute it and/or modify it under the terms of the GNU Lesser General Public License as published by the Free Software Foundation; either version 2.1 of the License, or (at your option) any later version.",
    "Apache-2.0-header": "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in compliance with the License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0 "
    "Unless required by applicable law or agreed to in writing, software distributed under the License is distributed on an \"AS IS\" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied. "
    "See the License for the specific language governing permissions and limitations under the License.",
    "MIT-text": "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the \"Software\"), to deal in the Software without restriction, including without "
    "limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the following conditions: "
    "The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software. THE SOFTWARE IS PROVIDED \"AS IS\", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, "
    "INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, "
    "WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE.",
    "ISC-text": "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the above copyright notice and this permission notice appear in all copies. "
    "THE SOFTWARE IS PROVIDED \"AS IS\" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING ALL IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL THE AUTHOR BE LIABLE FOR ANY SPECIAL, "
    "DIRECT, INDIRECT, OR CONSEQUENTIAL DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING FROM LOSS OF USE, DATA OR PROFITS, WHETHER IN AN ACTION OF CONTRACT, NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING OUT OF OR IN CONNECTION WITH THE "
    "USE OR PERFORMANCE OF THIS SOFTWARE.",
    "BSD-2-Clause-text": _BSD + _AS_IS,
    "BSD-3-Clause-text": _BSD + "3. Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from this software without specific prior written permission. " + _AS_IS,
}
#: A template is found from this coverage on.
COVERAGE = 0.85


def words(text: str) -> list[str]:
    return WORD.findall(text.translate(LOWER_AZ))


def longest_rising(pairs: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """The longest subsequence of pairs (sorted by the first) whose second numbers rise, by patience piles."""
    tops, at, back = [], [], []
    for k, (_, b) in enumerate(pairs):
        p = bisect_left(tops, b)
        back.append(at[p - 1] if p else -1)
        if p == len(tops):
            tops.append(b)
            at.append(k)
        else:
            tops[p], at[p] = b, k
    out, k = [], at[-1] if at else -1
    while k >= 0:
        out.append(pairs[k])
        k = back[k]
    return out[::-1]


def align(template: list[str], text: list[str]) -> list[tuple[int, int]]:
    """Matched positions (in template, in text): equal ends, then anchors unique to both, then the gaps likewise."""
    out, todo = [], [(0, len(template), 0, len(text))]
    while todo:
        a, b, c, d = todo.pop()
        while a < b and c < d and template[a] == text[c]:
            out.append((a, c))
            a, c = a + 1, c + 1
        while a < b and c < d and template[b - 1] == text[d - 1]:
            b, d = b - 1, d - 1
            out.append((b, d))
        if a == b or c == d:
            continue
        wanted = Counter(template[a:b])
        times = Counter(w for w in text[c:d] if w in wanted)
        place = {w: k for k, w in enumerate(text[c:d], c) if times.get(w) == 1}
        anchors = longest_rising([(k, place[template[k]]) for k in range(a, b) if wanted[template[k]] == 1 and template[k] in place])
        if anchors:
            out += anchors
            ends = [(a - 1, c - 1), *anchors, (b, d)]
            todo += [(x + 1, y, u + 1, v) for (x, u), (y, v) in zip(ends, ends[1:])]
    return sorted(out)


def common(a: list[str], b: list[str]) -> int:
    """The length of the longest common subsequence, in bits of one number."""
    at: dict[str, int] = {}
    for k, w in enumerate(a):
        at[w] = at.get(w, 0) | 1 << k
    every = (1 << len(a)) - 1
    v = every
    for w in b:
        if m := at.get(w):
            u = v & m
            v = ((v + u) | (v - u)) & every
    return len(a) - v.bit_count()


def longest(a: list[str], b: list[str]) -> list[tuple[int, int]]:
    """The pairs of a longest common subsequence, by its table."""
    n = [[0] * (len(b) + 1) for _ in range(len(a) + 1)]
    for i in range(len(a) - 1, -1, -1):
        for j in range(len(b) - 1, -1, -1):
            n[i][j] = n[i + 1][j + 1] + 1 if a[i] == b[j] else max(n[i + 1][j], n[i][j + 1])
    out, i, j = [], 0, 0
    while i < len(a) and j < len(b):
        if a[i] == b[j]:
            out.append((i, j))
            i, j = i + 1, j + 1
        elif n[i + 1][j] >= n[i][j + 1]:
            i += 1
        else:
            j += 1
    return out


def best_alignment(template: list[str], text: list[str], coverage: float = COVERAGE, places: dict[str, list[int]] | None = None) -> tuple[float, int, int]:
    """Coverage of the template, and the first and last matched word + 1, over stretches of the whole text; 0 below `coverage`.

    A notice that reaches `coverage` lacks at most `spare` of the template's words, so it holds one of any spare + 1 of
    them: a stretch of twice the template's length lies round each place of the spare + 1 that the text has least often.
    In a stretch, patience may fall short where words repeat; then a longest common subsequence is taken.
    """
    n = len(template)
    if places is None:
        places = places_of(set(template), text)
    least = next(m for m in range(n + 1) if m / n >= coverage)
    spare = n - least
    seeds = sorted(range(n), key=lambda i: (len(places.get(template[i], ())), i))[: spare + 1]
    known, best, done = set(template), (0.0, 0, 0), set()
    for i in seeds:
        for k in places.get(template[i], ()):
            low, high = max(0, k - 2 * i - 2), k + 2 * (n - i) + 2
            if (low, high) in done:
                continue
            done.add((low, high))
            stretch = text[low:high]
            there = known.intersection(stretch)
            if sum(w in there for w in template) < least or (size := common(template, stretch)) < max(least, 1) or size < best[0] * n:
                continue
            matched = align(template, stretch)
            if len(matched) < size:
                matched = longest(template, stretch)
            best = max(best, (len(matched) / n, -(low + matched[0][1]), low + matched[-1][1] + 1))
    return best[0], -best[1], best[2]


def places_of(wanted: set[str], text: list[str]) -> dict[str, list[int]]:
    """Where each wanted word stands in the text."""
    out: dict[str, list[int]] = {}
    for k, w in enumerate(text):
        if w in wanted:
            out.setdefault(w, []).append(k)
    return out


def scan_licenses(docs: DataFrame, templates: dict[str, str] | None = None, coverage: float = COVERAGE, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, license, coverage, start_word, end_word, found: one row per row of docs, whole texts, no shuffle.

    license is the template of most coverage if that reaches `coverage` (ties: the longer, then the first by name), else
    null with coverage 0; found lists all that do, sorted. A template of which less than that share of words is in the
    text can't reach it and isn't aligned. A notice stands within a stretch of twice its template's length (words between
    its own: at most as many as these), anywhere in the whole text, which may be very long. Null or empty text: none.
    Null ids and repeated rows stay, equal texts have equal results; an empty table gives no rows; other columns are ignored.
    """
    wanted = {name: words(t) for name, t in (TEMPLATES if templates is None else templates).items() if words(t)}
    vocabulary = set().union(*wanted.values())

    def scan(text: str | None) -> tuple:
        if not text:
            return None, 0.0, None, None, []
        w = words(text)
        there = places_of(vocabulary, w)
        hits = []
        for name, t in wanted.items():
            if sum(x in there for x in t) >= coverage * len(t):
                c, a, b = best_alignment(t, w, coverage, there)
                if c >= coverage:
                    hits.append((-c, -len(t), name, a, b))
        if not hits:
            return None, 0.0, None, None, []
        c, _, name, a, b = min(hits)
        return name, -c, a, b, sorted(h[2] for h in hits)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kinds = (pa.string(), pa.float64(), pa.int64(), pa.int64(), pa.list_(pa.string()))
        for b in batches:
            rows = [scan(t.as_py()) for t in b.column(1)]
            yield pa.RecordBatch.from_arrays([b.column(0), *[pa.array([r[k] for r in rows], kind) for k, kind in enumerate(kinds)]], names=["doc_id", "license", "coverage", "start_word", "end_word", "found"])

    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    return rows.mapInArrow(run, "doc_id long, license string, coverage double, start_word long, end_word long, found array<string>")
