"""License scans: texts and notices of licences found in documents.

Word runs of the templates are hashed and winnowed: of every few neighbouring hashes the least is kept, so
that any run of a certain length that a document shares with a template shares a kept hash.  Kept hashes of
all templates make an inverted index, and a document's hits in it pick candidates.  Hits of a template that lie near one
diagonal are aligned with it, word by word, within a band: the alignment gives the share of the template's
words that the document has, in order, and where they lie.
"""

from __future__ import annotations

from bisect import bisect
from collections import Counter
from collections.abc import Iterator, Mapping

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from plumbline.llm.common import quoted, text_of
from plumbline.llm.texthash import ALNUM, Words, words_of

#: Words of a hashed run, neighbouring runs of which one is kept: a shared run of RUN + WINDOW - 1 words is always hit.
RUN, WINDOW = 3, 2
#: Words that an alignment may shift (an eighth of the template, if that is less), least share of a template's words, and least words of it (or all).
BAND, LEAST, WORDS = 12, 0.6, 6

# Notices and texts of public licences.  Texts are whole; the long licences are known by their headers and notices.
TEMPLATES = {
    "MIT-notice": "Released under the MIT License.",
    "Apache-2.0-notice": "Licensed under the Apache License, Version 2.0.",
    "GPL-2.0-notice": "This work is licensed under the GNU General Public License, version 2.",
    "GPL-3.0-notice": "This work is licensed under the GNU General Public License, version 3.",
    "LGPL-2.1-notice": "This work is licensed under the GNU Lesser General Public License, version 2.1.",
    "LGPL-3.0-notice": "This work is licensed under the GNU Lesser General Public License, version 3.",
    "AGPL-3.0-notice": "This work is licensed under the GNU Affero General Public License, version 3.",
    "CC-BY-4.0-notice": "Licensed under CC BY 4.0.",
    "CC-BY-NC-4.0-notice": "Licensed under CC BY-NC 4.0.",
    "CC-BY-SA-4.0-notice": "Licensed under CC BY-SA 4.0.",
    "CC-BY-ND-4.0-notice": "Licensed under CC BY-ND 4.0.",
    "CC-BY-NC-SA-4.0-notice": "Licensed under CC BY-NC-SA 4.0.",
    "CC-BY-NC-ND-4.0-notice": "Licensed under CC BY-NC-ND 4.0.",
    "CC0-1.0-notice": "Licensed under CC0 1.0 Universal.",
    "MIT": (
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation"
        ' files (the "Software"), to deal in the Software without restriction, including without limitation the rights to use, copy,'
        " modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the"
        " Software is furnished to do so, subject to the following conditions: The above copyright notice and this permission notice"
        " shall be included in all copies or substantial portions of the Software."
        ' THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE'
        " WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS OR"
        " COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE,"
        " ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE."
    ),
    "BSD-2-Clause": (
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following"
        " conditions are met: 1. Redistributions of source code must retain the above copyright notice, this list of conditions and the"
        " following disclaimer. 2. Redistributions in binary form must reproduce the above copyright notice, this list of conditions and"
        " the following disclaimer in the documentation and/or other materials provided with the distribution."
        " THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS \"AS IS\" AND ANY EXPRESS OR IMPLIED WARRANTIES,"
        " INCLUDING, BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE DISCLAIMED."
        " IN NO EVENT SHALL THE COPYRIGHT HOLDER OR CONTRIBUTORS BE LIABLE FOR ANY DIRECT, INDIRECT, INCIDENTAL, SPECIAL, EXEMPLARY, OR"
        " CONSEQUENTIAL DAMAGES (INCLUDING, BUT NOT LIMITED TO, PROCUREMENT OF SUBSTITUTE GOODS OR SERVICES; LOSS OF USE, DATA, OR"
        " PROFITS; OR BUSINESS INTERRUPTION) HOWEVER CAUSED AND ON ANY THEORY OF LIABILITY, WHETHER IN CONTRACT, STRICT LIABILITY, OR"
        " TORT (INCLUDING NEGLIGENCE OR OTHERWISE) ARISING IN ANY WAY OUT OF THE USE OF THIS SOFTWARE, EVEN IF ADVISED OF THE"
        " POSSIBILITY OF SUCH DAMAGE."
    ),
    "BSD-3-Clause": (
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following"
        " conditions are met: 1. Redistributions of source code must retain the above copyright notice, this list of conditions and the"
        " following disclaimer. 2. Redistributions in binary form must reproduce the above copyright notice, this list of conditions and"
        " the following disclaimer in the documentation and/or other materials provided with the distribution."
        " 3. Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products"
        " derived from this software without specific prior written permission."
        " THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS \"AS IS\" AND ANY EXPRESS OR IMPLIED WARRANTIES,"
        " INCLUDING, BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE DISCLAIMED."
        " IN NO EVENT SHALL THE COPYRIGHT HOLDER OR CONTRIBUTORS BE LIABLE FOR ANY DIRECT, INDIRECT, INCIDENTAL, SPECIAL, EXEMPLARY, OR"
        " CONSEQUENTIAL DAMAGES (INCLUDING, BUT NOT LIMITED TO, PROCUREMENT OF SUBSTITUTE GOODS OR SERVICES; LOSS OF USE, DATA, OR"
        " PROFITS; OR BUSINESS INTERRUPTION) HOWEVER CAUSED AND ON ANY THEORY OF LIABILITY, WHETHER IN CONTRACT, STRICT LIABILITY, OR"
        " TORT (INCLUDING NEGLIGENCE OR OTHERWISE) ARISING IN ANY WAY OUT OF THE USE OF THIS SOFTWARE, EVEN IF ADVISED OF THE"
        " POSSIBILITY OF SUCH DAMAGE."
    ),
    "ISC": (
        "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted,"
        " provided that the above copyright notice and this permission notice appear in all copies."
        ' THE SOFTWARE IS PROVIDED "AS IS" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING ALL IMPLIED'
        " WARRANTIES OF MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL THE AUTHOR BE LIABLE FOR ANY SPECIAL, DIRECT, INDIRECT, OR"
        " CONSEQUENTIAL DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING FROM LOSS OF USE, DATA OR PROFITS, WHETHER IN AN ACTION OF CONTRACT,"
        " NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING OUT OF OR IN CONNECTION WITH THE USE OR PERFORMANCE OF THIS SOFTWARE."
    ),
    "Zlib": (
        "This software is provided 'as-is', without any express or implied warranty. In no event will the authors be held liable for any"
        " damages arising from the use of this software. Permission is granted to anyone to use this software for any purpose, including"
        " commercial applications, and to alter it and redistribute it freely, subject to the following restrictions: 1. The origin of"
        " this software must not be misrepresented; you must not claim that you wrote the original software. If you use this software"
        " in a product, an acknowledgment in the product documentation would be appreciated but is not required. 2. Altered source"
        " versions must be plainly marked as such, and must not be misrepresented as being the original software. 3. This notice may"
        " not be removed or altered from any source distribution."
    ),
    "Unlicense": (
        "This is free and unencumbered software released into the public domain. Anyone is free to copy, modify, publish, use, compile,"
        " sell, or distribute this software, either in source code form or as a compiled binary, for any purpose, commercial or"
        " non-commercial, and by any means. In jurisdictions that recognize copyright laws, the author or authors of this software"
        " dedicate any and all copyright interest in the software to the public domain."
    ),
    "Apache-2.0": (
        'Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in compliance with the'
        " License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0 Unless required by applicable law"
        ' or agreed to in writing, software distributed under the License is distributed on an "AS IS" BASIS, WITHOUT WARRANTIES OR'
        " CONDITIONS OF ANY KIND, either express or implied. See the License for the specific language governing permissions and"
        " limitations under the License."
    ),
    "MPL-2.0": (
        "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was not distributed"
        " with this file, You can obtain one at http://mozilla.org/MPL/2.0/."
    ),
} | {
    # the headers of one family, which differ in the licence's name and number only
    name: (
        f"This program is free software: you can redistribute it and/or modify it under the terms of the GNU {family} as"
        f" published by the Free Software Foundation, either version {number} of the License, or (at your option) any later version."
    )
    for name, family, number in (
        ("GPL-2.0-or-later", "General Public License", "2"),
        ("GPL-3.0-or-later", "General Public License", "3"),
        ("LGPL-2.1-or-later", "Lesser General Public License", "2.1"),
        ("LGPL-3.0-or-later", "Lesser General Public License", "3"),
        ("AGPL-3.0-or-later", "Affero General Public License", "3"),
    )
}
#: Templates of at most so many words are notices: found only as they are, since a word more or less is another licence.
NOTICE = 16
# Templates are rivals if they have this share of the shorter one's words in common and lengths within this factor; that many telling words
# may be damaged only where there are more than a few.
_COMMON, _FACTOR, _FEW, _MOST = 0.8, 1.35, 5, 0.8


def _kept(words: Words) -> tuple[np.ndarray, np.ndarray]:
    """Places (of words) and hashes that winnowing keeps, of all texts."""
    hashes, edges = words.shingles(RUN)
    text = np.repeat(np.arange(len(edges) - 1), np.diff(edges))
    place = words.bounds[text] + np.arange(len(hashes)) - edges[text]
    if len(hashes) < WINDOW:
        return place, hashes
    # the place of the least of each window; a text of fewer runs than a window keeps all
    best = np.arange(len(hashes) - WINDOW + 1)
    for k in range(1, WINDOW):
        other = np.arange(k, len(hashes) - WINDOW + 1 + k)
        best = np.where(hashes[other] <= hashes[best], other, best)
    inside = text[: len(best)] == text[WINDOW - 1 :]
    keep = np.zeros(len(hashes), dtype=bool)
    keep[best[inside]] = True
    keep[(np.diff(edges) < WINDOW)[text]] = True
    return place[keep], hashes[keep]


class Index:
    """The kept hashes of all templates, sorted, with the template and place of each."""

    def __init__(self, templates: Mapping[str, str]):
        self.names = sorted(templates)
        self.words = [next(iter(w for _, w in words_of(pa.array([templates[n]]), table=ALNUM))).hashes for n in self.names]
        rows = []
        for k, name in enumerate(self.names):
            for _, words in words_of(pa.array([templates[name]]), table=ALNUM):
                rows += [(int(h), k, int(p)) for p, h in zip(*_kept(words), strict=True)]
        rows.sort()
        self.rivals = [self._rivals(k) for k in range(len(self.words))]
        self.bands = np.array([max(1, min(BAND, len(w) // 8)) for w in self.words])
        self.hashes = np.array([r[0] for r in rows], dtype=np.uint64)
        self.template = np.array([r[1] for r in rows], dtype=np.int64)
        self.place = np.array([r[2] for r in rows], dtype=np.int64)

    def _rivals(self, k: int) -> list[tuple[Counter, Counter]]:
        """For each rival of a template: the words that only the one has, and that only the other has, as often as they differ."""
        mine, out = Counter(self.words[k].tolist()), []
        for j, words in enumerate(self.words):
            shorter, longer = sorted((len(words), len(self.words[k])))
            theirs = Counter(words.tolist())
            if j != k and longer <= _FACTOR * shorter and (mine & theirs).total() >= _COMMON * shorter:
                out.append((mine - theirs, theirs - mine))
        return out

    def told(self, k: int, span: np.ndarray, matched: int) -> bool:
        """Whether a place has a template's own words, and not a rival's, where the two differ."""
        goal = len(self.words[k])
        if goal <= NOTICE:
            return matched == goal == len(span)
        held = Counter(span.tolist())
        extra = held - Counter(self.words[k].tolist())
        for mine, theirs in self.rivals[k]:
            has, other = (held & mine).total(), (extra & theirs).total()
            if has < (mine.total() if mine.total() <= _FEW else _MOST * mine.total()):
                return False
            if other and other >= (1 if theirs.total() <= _FEW else theirs.total() / 2):
                return False
        return True

    def hits(self, places: np.ndarray, hashes: np.ndarray) -> np.ndarray:
        """Rows of (template, diagonal) sorted, for kept hashes of one text."""
        low, high = np.searchsorted(self.hashes, hashes, "left"), np.searchsorted(self.hashes, hashes, "right")
        times = high - low
        at = np.repeat(low, times) + np.arange(times.sum()) - np.repeat(np.cumsum(times) - times, times)
        found = np.stack([self.template[at], np.repeat(places, times) - self.place[at]], axis=1)
        return found[np.lexsort((found[:, 1], found[:, 0]))]


def align(text: np.ndarray, template: np.ndarray, low: int, high: int) -> tuple[int, int, int]:
    """Local alignment of a template with a text, on diagonals low..high: matched words, first and last word of the text, end exclusive.

    A match scores 2; a word that differs, is missing or is added costs 1.
    """
    width = high - low + 1
    best, at = 0, (0, 0, 0)
    score, matched = np.zeros(width, dtype=np.int64), np.zeros(width, dtype=np.int64)
    begin = np.full(width, -1, dtype=np.int64)
    for j in range(len(template)):
        new, count, start = np.zeros_like(score), np.zeros_like(matched), np.full(width, -1, dtype=np.int64)
        for d in range(width):
            i = j + low + d
            if not 0 <= i < len(text):
                continue
            same = text[i] == template[j]
            options = [(score[d] + (2 if same else -1), matched[d] + same, begin[d])]
            if d + 1 < width:  # a word of the template is missing from the text
                options.append((score[d + 1] - 1, matched[d + 1], begin[d + 1]))
            if d:  # the text has a word more
                options.append((new[d - 1] - 1, count[d - 1], start[d - 1]))
            value, n, first = max(options, key=lambda o: o[:2])
            if value > 0:
                new[d], count[d], start[d] = value, n, first if first >= 0 else i
                if value > best:
                    best, at = int(value), (int(n), int(start[d]), i + 1)
        score, matched, begin = new, count, start
    return at


def _clusters(found: np.ndarray, bands: np.ndarray) -> Iterator[tuple[int, int, int]]:
    """Runs of hits of one template on near diagonals: template, least and greatest diagonal."""
    cuts = np.flatnonzero((np.diff(found[:, 0]) != 0) | (np.diff(found[:, 1]) > bands[found[1:, 0]])) + 1
    for part in np.split(found, cuts):
        if len(part):
            yield int(part[0, 0]), int(part[0, 1]), int(part[-1, 1])


_ROW = "license string, coverage double, matched long, start long, end long"


def scan(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text", templates: Mapping[str, str] = TEMPLATES, least: float = LEAST) -> DataFrame:
    """Columns ``doc_id, license, coverage, matched, start, end``: a row for each place that has at least the share ``least`` of a template's words.

    Places are in code points of the text, end exclusive.  Words are runs of letters and digits, A-Z in lower case.
    Of places that overlap, the one with the most words of its template stays, then that of the largest share, then the first.  A
    notice has to be there as it is.  Where a template and its rivals, which have most words in common with it, differ, the place
    must have its words and not theirs: a text between two licences is none of them.  Texts without licences, null
    and empty ones have no row; repeated rows have theirs each.  Templates of fewer than RUN words are only found as whole texts
    of so few words; without templates there are no rows.
    """
    kind = docs.schema[id_column].dataType.simpleString()
    index = Index(templates)

    def places(words: Words, i: int, kept: tuple[np.ndarray, np.ndarray]) -> list[tuple]:
        a, b = words.bounds[i], words.bounds[i + 1]
        own = words.hashes[a:b]
        found = []
        for template, low, high in _clusters(index.hits(kept[0] - a, kept[1]), index.bands):
            goal, band = index.words[template], int(index.bands[template])
            enough = min(len(goal), max(WORDS, least * len(goal)))
            # a long run of near diagonals comes of many copies next to each other: each is aligned by itself
            for at in range(low, high + 1, band):
                n, first, last = align(own, goal, at - band, min(high, at + band - 1) + band)
                if n and n >= enough and index.told(template, own[first:last], n):
                    found.append((-n, -n / len(goal), first, last, template))
        if not found:
            return []
        base = words.edges[i]
        letters = np.concatenate([[0], np.cumsum((words.raw[base : words.edges[i + 1]] & 0xC0) != 0x80)])  # code points before each byte
        out, taken = [], []
        for n, _, first, last, template in sorted(set(found)):
            at = bisect(taken, (first, last))
            if (at and taken[at - 1][1] > first) or (at < len(taken) and taken[at][0] < last):
                continue
            taken.insert(at, (first, last))
            start, end = letters[words.starts[a + first] - base], letters[words.ends[a + last - 1] - base]
            out.append((index.names[template], -n / len(index.words[template]), -n, int(start), int(end)))
        return sorted(out, key=lambda r: r[3:])

    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, rows = [], []
            for first, words in words_of(batch.column(1), table=ALNUM):
                place, hashes = _kept(words)
                hit = np.isin(hashes, index.hashes)
                place, hashes = place[hit], hashes[hit]
                text = np.searchsorted(words.bounds, place, "right") - 1
                for i in np.unique(text):
                    for row in places(words, int(i), (place[text == i], hashes[text == i])):
                        ids.append(first + int(i))
                        rows.append(row)
            columns = list(zip(*rows, strict=True)) or [[]] * 5
            kinds = (pa.string(), pa.float64(), pa.int64(), pa.int64(), pa.int64())
            arrays = [pa.array(c, t) for c, t in zip(columns, kinds, strict=True)]
            yield pa.RecordBatch.from_arrays([batch.column(0).take(pa.array(ids, pa.int64())), *arrays], ["doc_id", "license", "coverage", "matched", "start", "end"])

    return docs.select(quoted(id_column).alias("doc_id"), text_of(text_column).alias("text")).mapInArrow(find, f"doc_id {kind}, {_ROW}")
