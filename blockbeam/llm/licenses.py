"""License scans: winnowed fingerprints pick candidates, banded alignment reports spans.

Texts and templates are read as words ``[a-z0-9]+`` of the lower-cased text. A template's fingerprints
are the smallest hash of every window of consecutive n-word hashes (winnowing). An inverted index maps a fingerprint to its
templates and places; it is as large as the templates, which are checked to be at most
``MAX_WORDS`` words, and goes to every task. All grams of every text are looked up in it, and hits of one template are
chained to candidates. Local alignments (match 1, mismatch and gap -1) on the diagonals of a candidate's hits (place in
the text less place in the template), for long templates also ``BAND`` beside them, give the words matched
and the spans of the text: the best that covers enough, then the best beside it, and so on.

Grams get shorter with the template (``grams_for``):

* up to ``SHORT`` words, and where runs of other lengths might hold no fingerprint, every word is one. Hits are chained by
  place: an alignment that covers enough spans less than two words of the text for each word of its
  template, and each word it matches is a hit, so it lies in a row of hits that are enough and close enough. No match is lost.
* longer templates have 2-word grams, or beyond ``LONG`` words 3-word grams in windows of ``WINDOW``. Hits are chained by diagonal, and
  a candidate needs some different fingerprints of the template (``least_hits``): one ``SHARE``-th of those that must be left (q-gram
  lemma) when as many words are lost or replaced as the coverage allows. So words put in between may break the
  others; the tests measure how much is found at 80 % coverage.

Defined results: null and empty texts match nothing;
null doc_ids are reported as null; repeated rows repeat their matches; a template that stands several
times in a text is reported for each. Of two overlapping matches of one template the better is
reported, the first on a tie. Extra columns are ignored.
"""

from __future__ import annotations

import re
from bisect import bisect_left
from collections.abc import Iterator
from heapq import heapify, heappop, heappush

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame, functions as F

from .common import Words, column, prepare, slices, windows

BAND, PERCENT, SHORT, LONG, WINDOW, SHARE = 8, 80, 16, 64, 2, 4
MAX_WORDS = 1_000_000

# Public license notices, by SPDX-like names.
TEMPLATES = {
    "MIT-notice": "Released under the MIT License.",
    "Apache-2.0-notice": "Licensed under the Apache License, Version 2.0.",
    "GPL-3.0-notice": "This work is licensed under the GNU General Public License, version 3.",
    "CC-BY-NC-4.0-notice": "Licensed under CC BY-NC 4.0.",
    "MIT": "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the Software), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the following conditions: The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software.",
    "ISC": "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the above copyright notice and this permission notice appear in all copies.",
    "Apache-2.0": "Licensed under the Apache License, Version 2.0 (the License); you may not use this file except in compliance with the License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0 Unless required by applicable law or agreed to in writing, software distributed under the License is distributed on an AS IS BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied.",
    "GPL-3.0": "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version.",
    "MIT-full": "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the Software), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the following conditions: The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software. THE SOFTWARE IS PROVIDED AS IS, WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE.",
    "BSD-3-Clause-full": "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met: 1. Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer. 2. Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer in the documentation and/or other materials provided with the distribution. 3. Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from this software without specific prior written permission. THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS AS IS AND ANY EXPRESS OR IMPLIED WARRANTIES, INCLUDING, BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE DISCLAIMED. IN NO EVENT SHALL THE COPYRIGHT HOLDER OR CONTRIBUTORS BE LIABLE FOR ANY DIRECT, INDIRECT, INCIDENTAL, SPECIAL, EXEMPLARY, OR CONSEQUENTIAL DAMAGES (INCLUDING, BUT NOT LIMITED TO, PROCUREMENT OF SUBSTITUTE GOODS OR SERVICES; LOSS OF USE, DATA, OR PROFITS; OR BUSINESS INTERRUPTION) HOWEVER CAUSED AND ON ANY THEORY OF LIABILITY, WHETHER IN CONTRACT, STRICT LIABILITY, OR TORT (INCLUDING NEGLIGENCE OR OTHERWISE) ARISING IN ANY WAY OUT OF THE USE OF THIS SOFTWARE, EVEN IF ADVISED OF THE POSSIBILITY OF SUCH DAMAGE.",
    "Zlib-full": "This software is provided 'as-is', without any express or implied warranty. In no event will the authors be held liable for any damages arising from the use of this software. Permission is granted to anyone to use this software for any purpose, including commercial applications, and to alter it and redistribute it freely, subject to the following restrictions: 1. The origin of this software must not be misrepresented; you must not claim that you wrote the original software. If you use this software in a product, an acknowledgment in the product documentation would be appreciated but is not required. 2. Altered source versions must be plainly marked as such, and must not be misrepresented as being the original software. 3. This notice may not be removed or altered from any source distribution.",
    "MPL-2.0": "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was not distributed with this file, You can obtain one at https://mozilla.org/MPL/2.0/.",
}

RESULT = "doc_id long, license string, n_matched int, coverage double, start_word long, end_word long, start_char long, end_char long"
_WORD = re.compile("[A-Za-z0-9]+")


def words_of(text: str) -> list[str]:
    return [w.lower() for w in _WORD.findall(text)]


def _grams(words: list[str], n: int) -> np.ndarray:
    h = np.fromiter((xxhash.xxh3_64_intdigest(w.encode()) for w in words), np.uint64, len(words))
    return windows(h, np.zeros(len(h), np.int32), n)[0]


def winnowed(grams: np.ndarray, window: int = WINDOW) -> np.ndarray:
    """Places of the smallest gram of each window, the last of equals."""
    if len(grams) <= window:
        return np.array([len(grams) - 1 - int(grams[::-1].argmin())]) if len(grams) else np.zeros(0, np.int64)
    view = np.lib.stride_tricks.sliding_window_view(grams, window)
    return np.unique(np.arange(len(view)) + window - 1 - view[:, ::-1].argmin(1))


def grams_for(size: int, need: int) -> tuple[int, int]:
    """Words of a gram, and grams of a winnowing window, for a template of so many words of which ``need`` must match."""
    for gram, window, least in ((3, WINDOW, LONG + 1), (2, 1, SHORT + 1)):
        # the words that need not match cut the others into runs, the longest of which must hold a fingerprint
        if size >= least and need > (gram + window - 2) * (size - need + 1):
            return gram, window
    return 1, 1


def least_hits(size: int, need: int, gram: int, window: int) -> int:
    """Different fingerprints that a candidate for such a template must hold."""
    left = size - gram + 1 - gram * (size - need)
    return max(1, left // (window * SHARE))


class Index:
    """Fingerprints of templates, sorted, with template and place of each; one part per gram size. ``by_place`` says whose
    every word is a fingerprint."""

    def __init__(self, templates: dict[str, str], percent: int = PERCENT):
        self.names = sorted(templates)
        self.words = [words_of(templates[n]) for n in self.names]
        if sum(map(len, self.words)) > MAX_WORDS:
            raise ValueError(f"templates of more than {MAX_WORDS} words; scan them in parts")
        self.need = [max(1, -(-percent * len(w) // 100)) for w in self.words]
        self.size = np.array([len(w) for w in self.words], np.int64)
        self.by_place = np.zeros(len(self.words), bool)
        self.least = np.ones(len(self.words), np.int64)
        found: dict[int, list[tuple[int, int, int]]] = {}
        for i, w in enumerate(self.words):
            gram, window = grams_for(len(w), self.need[i])
            self.least[i] = least_hits(len(w), self.need[i], gram, window)
            self.by_place[i] = gram == 1
            g = _grams(w, gram)
            found.setdefault(gram, []).extend((int(g[p]), i, int(p)) for p in winnowed(g, window))
        self.parts: dict[int, tuple[np.ndarray, np.ndarray, np.ndarray]] = {}
        for n, rows in found.items():
            rows.sort()
            self.parts[n] = (np.array([r[0] for r in rows], np.uint64), np.array([r[1] for r in rows], np.int64), np.array([r[2] for r in rows], np.int64))

    def hits(self, words: Words) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Text, template, place in the text and diagonal of every fingerprint found."""
        h = words.hashes()
        out = []
        for n, (keys, template, place) in self.parts.items():
            g, at = windows(h, words.doc, n)
            lo, hi = np.searchsorted(keys, g, "left"), np.searchsorted(keys, g, "right")
            some = np.flatnonzero(hi > lo)
            many = (hi - lo)[some]
            k = np.repeat(lo[some] - (np.cumsum(many) - many), many) + np.arange(many.sum())
            where = np.repeat(at[some], many)
            doc = words.doc[where].astype(np.int64)
            own = where - words.start[doc]
            out.append((doc, template[k], own, own - place[k]))
        return tuple(np.concatenate(x) for x in zip(*out, strict=True)) if out else (np.zeros(0, np.int64),) * 4

    def places(self, words: Words) -> list[tuple[int, int, int, int | None, int, int]]:
        """Candidates: text, template, begin and end in the text (None: as far as the diagonals go), and least and greatest diagonal."""
        doc, template, place, diagonal = self.hits(words)
        short = self.by_place[template] if len(template) else np.zeros(0, bool)
        far = candidates(doc[~short], template[~short], diagonal[~short], place[~short] - diagonal[~short], self.least)
        return [(d, t, 0, None, low - BAND, high + BAND) for d, t, low, high in far] + self.rows_of_hits(doc[short], template[short], place[short], diagonal[short])

    def rows_of_hits(self, doc: np.ndarray, template: np.ndarray, place: np.ndarray, diagonal: np.ndarray) -> list[tuple[int, int, int, int | None, int, int]]:
        """Candidates of templates whose every word is a fingerprint: spans of the text in which enough different places hit
        within two words for each word of the template."""
        if not len(doc):
            return []
        order = np.lexsort((place, template, doc))
        doc, template, place, diagonal = doc[order], template[order], place[order], diagonal[order]
        new = np.ones(len(doc), bool)  # a word that stands twice in a template hits twice at one place
        new[1:] = (doc[1:] != doc[:-1]) | (template[1:] != template[:-1]) | (place[1:] != place[:-1])
        at = np.flatnonzero(new)
        d, t, p = doc[at], template[at], place[at]
        last = np.arange(len(at)) + np.array(self.need)[t] - 1
        inside = np.flatnonzero(last < len(at))
        last = last[inside]
        ok = (d[last] == d[inside]) & (t[last] == t[inside]) & (p[last] - p[inside] < 2 * self.size[t[inside]])
        first, last = inside[ok], last[ok]
        if not len(first):
            return []
        # spans that meet in a place are one candidate
        cut = np.ones(len(first), bool)
        cut[1:] = first[1:] > last[:-1]
        begins = np.flatnonzero(cut)
        least = np.minimum.reduceat(diagonal, at)
        most = np.maximum.reduceat(diagonal, at)
        out = []
        for k, e in zip(begins.tolist(), np.append(begins[1:], len(first)).tolist(), strict=True):
            a, b = int(first[k]), int(last[e - 1])
            out.append((int(d[a]), int(t[a]), int(p[a]), int(p[b]) + 1, int(least[a : b + 1].min()), int(most[a : b + 1].max())))
        return out


def candidates(doc: np.ndarray, template: np.ndarray, diagonal: np.ndarray, place: np.ndarray, least: np.ndarray, band: int = BAND) -> list[tuple[int, int, int, int]]:
    """(text, template, least and greatest diagonal) of hits whose diagonals follow within ``band``, if they are hits of
    ``least`` different places of the template or more."""
    order = np.lexsort((diagonal, template, doc))
    doc, template, diagonal, place = doc[order], template[order], diagonal[order], place[order]
    if not len(doc):
        return []
    new = np.ones(len(doc), bool)
    new[1:] = (doc[1:] != doc[:-1]) | (template[1:] != template[:-1]) | (diagonal[1:] - diagonal[:-1] > band)
    at = np.flatnonzero(new)
    last = np.append(at[1:], len(doc)) - 1
    chain = np.cumsum(new) - 1
    held = np.bincount(np.unique(chain * (place.max() + 1) + place) // (place.max() + 1), minlength=len(at))
    full = held >= least[template[at]]
    at, last = at[full], last[full]
    return list(zip(doc[at].tolist(), template[at].tolist(), diagonal[at].tolist(), diagonal[last].tolist(), strict=True))


def ends(text: list[str], template: list[str], need: int, begin: int, end: int, low: int, high: int) -> list[tuple[int, int, int, int]]:
    """For each end in the text from ``begin`` to ``end`` the best local alignment there with ``need`` words matched or more,
    on diagonals ``low`` to ``high``: less its score, less its words matched, begin and end."""
    out = []
    before: dict[int, tuple[int, int, int]] = {}
    for j in range(begin, end):
        w, now = text[j], {}
        best = None
        for i in range(max(0, j - high), min(len(template), j - low + 1)):
            s, m, b = max(before.get(i - 1, (0, 0, j)), (0, 0, j), key=lambda c: (c[0], c[1]))
            cell = (s + 1, m + 1, b) if template[i] == w else (s - 1, m, b)
            for other in (before.get(i), now.get(i - 1)):
                if other and (other[0] - 1, other[1]) > cell[:2]:
                    cell = (other[0] - 1, *other[1:])
            if cell[0] > 0:
                now[i] = cell
                if cell[1] >= need and (best is None or cell[:2] > best[:2]):
                    best = cell
        if best:
            out.append((-best[0], -best[1], best[2], j + 1))
        before = now
    return out


def align(text: list[str], template: list[str], need: int, begin: int, end: int, low: int, high: int) -> list[tuple[int, int, int]]:
    """Words matched, and begin and end in the text, of the local alignments with ``need`` words matched or more that
    lie in the text from ``begin`` to ``end``: the best, then the best of those beside it, and so on."""
    heap = ends(text, template, need, begin, end, low, high)
    heapify(heap)
    taken: list[tuple[int, int, int]] = []  # begin, end, matched
    while heap:
        _, m, b, e = heappop(heap)
        k = bisect_left(taken, (b,))
        if (k and taken[k - 1][1] > b) or (k < len(taken) and taken[k][0] < e):
            continue
        taken.insert(k, (b, e, -m))
        # what began before or in this one may begin behind it as well; no alignment is twice as long as its template
        stop = min(end, e + 2 * len(template), taken[k + 1][0] if k + 1 < len(taken) else end)
        for cell in ends(text, template, need, e, stop, low, high):
            heappush(heap, cell)
    return [(m, b, e) for b, e, m in taken]


def license_scan(docs: DataFrame, templates: dict[str, str] | None = None, *, percent: int = PERCENT) -> DataFrame:
    """Matches of templates in every row of ``docs`` (doc_id, text) that cover ``percent`` of a template or more: words
    matched, coverage, and the span in words and in characters."""
    prepare(docs.sparkSession)
    index = Index(TEMPLATES if templates is None else templates, percent=percent)

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in slices(batches, "text"):
            text = column(b, "text")
            words = Words(pc.replace_substring_regex(pc.ascii_lower(pc.fill_null(text, "")), "[^a-z0-9]+", " "))
            rows: list[tuple] = []
            held: dict[int, list[str]] = {}
            spans: dict[int, list[tuple[int, int]]] = {}
            seen: dict[tuple[int, int], list[tuple]] = {}
            for d, t, begin, end, low, high in sorted(index.places(words), key=lambda p: p[:2]):
                if d not in held:
                    held.clear()
                    raw = text[d].as_py()
                    found = [(m.group().lower(), m.span()) for m in _WORD.finditer(raw)]
                    held[d], spans[d] = [w for w, _ in found], [s for _, s in found]
                own = index.words[t]
                first, last = max(begin, low), min(len(held[d]) if end is None else end, high + len(own))
                for matched, at, to in align(held[d], own, index.need[t], first, last, low, high):
                    seen.setdefault((d, t), []).append((-matched, at, to))
            for (d, t), hits in sorted(seen.items()):
                taken: list[tuple[int, int]] = []
                for m, begin, end in sorted(hits):
                    if all(end <= x or begin >= y for x, y in taken):
                        taken.append((begin, end))
                        rows.append((d, index.names[t], -m, -m / len(index.words[t]), begin, end, spans[d][begin][0], spans[d][end - 1][1]))
            if rows:
                cols = list(zip(*rows, strict=True))
                kinds = (pa.string(), pa.int32(), pa.float64(), *[pa.int64()] * 4)
                yield pa.RecordBatch.from_arrays([column(b, "doc_id").take(pa.array(cols[0])), *(pa.array(c, k) for c, k in zip(cols[1:], kinds, strict=True))], names=[x.split()[0] for x in RESULT.split(", ")])

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")).mapInArrow(scan, RESULT)
