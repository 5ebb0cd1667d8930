"""Licence scans with a generalised suffix automaton of licence words.

The automaton holds every run of words of all templates. Streaming a text's words through it
gives matching statistics: for each word, how long a run ending there stands in some template,
and in which. Runs that can't be continued and have at least ``LONG`` words are the long
matches; those of one template (at each of its places) that follow each other in the text and in the template, with at
most ``GAP`` words between, are chained into the spans that cover most. A span of at least ``COVERED`` matched words gives
the template's label, unless it lies in a span of another template that matches more. The base phrases are templates too: they end at a word exactly
if the automaton's state there, or one on its path of suffixes, is the phrase's.

Words are ``[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+`` after lower-casing A-Z. Null is the empty text: no
words, no labels, score 0. The score is 0.5 for a base phrase alone, and otherwise grows with the best
span's matched words up to 1 at ``SURE``. Repeated rows give equal results.
"""

from __future__ import annotations

import functools
from bisect import bisect_right
from collections.abc import Iterator
from itertools import groupby, repeat
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from tidemill.llm.common import append, slices, texts

LONG, GAP, COVERED, SURE = 4, 12, 6, 16

#: The base phrases and their labels.
PHRASES = {"mit license": "mit", "apache license": "apache", "general public license": "gpl"}

_AS_IS = "THE SOFTWARE IS PROVIDED AS IS, WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT."
_LIABLE = "IN NO EVENT SHALL THE AUTHORS {who}BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE."
_BSD = "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met: 1. Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer. 2. Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer in the documentation and/or other materials provided with the distribution."
_BSD_3 = "3. Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from this software without specific prior written permission."
_BSD_END = "THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS AS IS AND ANY EXPRESS OR IMPLIED WARRANTIES, INCLUDING, BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE DISCLAIMED. IN NO EVENT SHALL THE COPYRIGHT HOLDER OR CONTRIBUTORS BE LIABLE FOR ANY DIRECT, INDIRECT, INCIDENTAL, SPECIAL, EXEMPLARY, OR CONSEQUENTIAL DAMAGES (INCLUDING, BUT NOT LIMITED TO, PROCUREMENT OF SUBSTITUTE GOODS OR SERVICES; LOSS OF USE, DATA, OR PROFITS; OR BUSINESS INTERRUPTION) HOWEVER CAUSED AND ON ANY THEORY OF LIABILITY, WHETHER IN CONTRACT, STRICT LIABILITY, OR TORT (INCLUDING NEGLIGENCE OR OTHERWISE) ARISING IN ANY WAY OUT OF THE USE OF THIS SOFTWARE, EVEN IF ADVISED OF THE POSSIBILITY OF SUCH DAMAGE."

#: Wordings of public licences, and the labels that they give. Short licences stand whole (MIT, BSD, ISC, zlib,
#: Boost, Unlicense, WTFPL); of the long ones (Apache, GPL, LGPL, AGPL, MPL, Creative Commons) the notices that files carry.
TEMPLATES = [
    ("mit", "released under the mit license"),
    ("mit", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the Software), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the following conditions: The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software. " + _AS_IS + " " + _LIABLE.format(who="OR COPYRIGHT HOLDERS ")),
    ("apache", "licensed under the apache license version 2.0"),
    ("apache", "Licensed under the Apache License, Version 2.0 (the License); you may not use this file except in compliance with the License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0 Unless required by applicable law or agreed to in writing, software distributed under the License is distributed on an AS IS BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied. See the License for the specific language governing permissions and limitations under the License."),
    ("gpl", "this work is licensed under the gnu general public license version 3"),
    ("gpl", "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version. This program is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; without even the implied warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE. See the GNU General Public License for more details. You should have received a copy of the GNU General Public License along with this program. If not, see http://www.gnu.org/licenses/."),
    ("lgpl", "gnu lesser general public license version 3"),
    ("lgpl", "gnu lesser general public license v2.1"),
    ("agpl", "gnu affero general public license version 3"),
    ("bsd", "bsd 2 clause license"),
    ("bsd", "bsd 3 clause license"),
    ("bsd", f"{_BSD} {_BSD_END}"),
    ("bsd", f"{_BSD} {_BSD_3} {_BSD_END}"),
    ("isc", "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the above copyright notice and this permission notice appear in all copies. THE SOFTWARE IS PROVIDED AS IS AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING ALL IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL THE AUTHOR BE LIABLE FOR ANY SPECIAL, DIRECT, INDIRECT, OR CONSEQUENTIAL DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING FROM LOSS OF USE, DATA OR PROFITS, WHETHER IN AN ACTION OF CONTRACT, NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING OUT OF OR IN CONNECTION WITH THE USE OR PERFORMANCE OF THIS SOFTWARE."),
    ("zlib", "This software is provided 'as-is', without any express or implied warranty. In no event will the authors be held liable for any damages arising from the use of this software. Permission is granted to anyone to use this software for any purpose, including commercial applications, and to alter it and redistribute it freely, subject to the following restrictions: 1. The origin of this software must not be misrepresented; you must not claim that you wrote the original software. If you use this software in a product, an acknowledgment in the product documentation would be appreciated but is not required. 2. Altered source versions must be plainly marked as such, and must not be misrepresented as being the original software. 3. This notice may not be removed or altered from any source distribution."),
    ("boost", "Permission is hereby granted, free of charge, to any person or organization obtaining a copy of the software and accompanying documentation covered by this license (the Software) to use, reproduce, display, distribute, execute, and transmit the Software, and to prepare derivative works of the Software, and to permit third-parties to whom the Software is furnished to do so, all subject to the following: The copyright notices in the Software and this entire statement, including the above license grant, this restriction and the following disclaimer, must be included in all copies of the Software, in whole or in part, and all derivative works of the Software, unless such copies or derivative works are solely in the form of machine-executable object code generated by a source language processor."),
    ("wtfpl", "Everyone is permitted to copy and distribute verbatim or modified copies of this license document, and changing it is allowed as long as the name is changed. DO WHAT THE FUCK YOU WANT TO PUBLIC LICENSE TERMS AND CONDITIONS FOR COPYING, DISTRIBUTION AND MODIFICATION 0. You just DO WHAT THE FUCK YOU WANT TO."),
    ("mpl", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was not distributed with this file, You can obtain one at http://mozilla.org/MPL/2.0/."),
    ("unlicense", "This is free and unencumbered software released into the public domain. Anyone is free to copy, modify, publish, use, compile, sell, or distribute this software, either in source code form or as a compiled binary, for any purpose, commercial or non-commercial, and by any means. In jurisdictions that recognize copyright laws, the author or authors of this software dedicate any and all copyright interest in the software to the public domain. We make this dedication for the benefit of the public at large and to the detriment of our heirs and successors. We intend this dedication to be an overt act of relinquishment in perpetuity of all present and future rights to this software under copyright law. " + _AS_IS + " " + _LIABLE.format(who="")),
    ("cc-by", "this work is licensed under a creative commons attribution 4.0 international license"),
    ("cc-by-sa", "licensed under cc by sa 4.0"),
    ("cc-by-sa", "this work is licensed under a creative commons attribution sharealike 4.0 international license"),
    ("cc-by-nc", "licensed under cc by nc 4.0"),
    ("cc-by-nc", "this work is licensed under a creative commons attribution noncommercial 4.0 international license"),
]

#: Every byte that is in no word becomes a space, and A-Z is lower-cased.
_TABLE = bytes(c + 32 if 65 <= c <= 90 else c if 48 <= c <= 57 or 97 <= c <= 122 or c >= 128 else 32 for c in range(256))


def words(text: bytes) -> list[bytes]:
    return text.translate(_TABLE).split()


class Span(NamedTuple):
    """A covered span: words [start, end) of the text lie in words [at, to) of a template."""

    template: int
    start: int
    end: int
    at: int
    to: int
    matched: int


class Scan(NamedTuple):
    n_words: int
    places: list[tuple[int, str]]  # of base phrases: first word, label
    spans: list[Span]


class Automaton:
    """A generalised suffix automaton (Blumer et al., 1987) of lists of words."""

    def __init__(self, phrases: dict[str, str], templates: list[tuple[str, str]]) -> None:
        self.labels = [*phrases.values(), *(label for label, _ in templates)]
        lines = [words(x.encode()) for x in [*phrases, *(t for _, t in templates)]]
        self.sizes, self.phrases = [len(x) for x in lines], len(phrases)
        self.ids: dict[bytes, int] = {}
        for line in lines:
            for w in line:
                self.ids.setdefault(w, len(self.ids) + 1)
        self.next: list[dict[int, int]] = [{}]
        self.link, self.len = [-1], [0]
        coded = [[self.ids[w] for w in line] for line in lines]
        for line in coded:
            last = 0
            for c in line:
                last = self._extend(last, c)
        # Where in each template a state's runs end: all places.
        self.ends: list[dict[int, list[int]]] = [{} for _ in self.next]
        for t, line in enumerate(coded):
            v = 0
            for i, c in enumerate(line, 1):
                u = v = self.next[v][c]
                while u > 0:
                    self.ends[u].setdefault(t, []).append(i)
                    u = self.link[u]
        # The phrases that end wherever a state's run does: (words, template).
        own: dict[int, list[tuple[int, int]]] = {}
        for t, line in enumerate(coded[: self.phrases]):
            v = 0
            for c in line:
                v = self.next[v][c]
            own.setdefault(v, []).append((len(line), t))
        self.closing: list[list[tuple[int, int]]] = []
        for v in range(len(self.next)):
            found, u = [], v
            while u > 0:
                found += own.get(u, [])
                u = self.link[u]
            self.closing.append(found)

    def _extend(self, last: int, c: int) -> int:
        if c in self.next[last]:
            q = self.next[last][c]
            return q if self.len[q] == self.len[last] + 1 else self._clone(last, c, q)
        new = self._state(self.len[last] + 1)
        p = last
        while p >= 0 and c not in self.next[p]:
            self.next[p][c] = new
            p = self.link[p]
        if p < 0:
            self.link[new] = 0
        else:
            q = self.next[p][c]
            self.link[new] = q if self.len[q] == self.len[p] + 1 else self._clone(p, c, q)
        return new

    def _state(self, size: int) -> int:
        self.next.append({})
        self.link.append(0)
        self.len.append(size)
        return len(self.next) - 1

    def _clone(self, p: int, c: int, q: int) -> int:
        new = self._state(self.len[p] + 1)
        self.next[new], self.link[new] = dict(self.next[q]), self.link[q]
        self.link[q] = new
        while p >= 0 and self.next[p].get(c) == q:
            self.next[p][c] = new
            p = self.link[p]
        return new

    def scan(self, text: bytes) -> Scan:
        found = words(text)
        n = len(found)
        known = np.fromiter(map(self.ids.get, found, repeat(0)), np.int32, n)
        # Runs of two or more words that templates have; a lone one can't be a phrase or a long match.
        edges = np.flatnonzero(np.diff(np.concatenate(([0], known != 0, [0]))))
        starts, ends = edges[::2], edges[1::2]
        some = ends - starts > 1
        places: list[tuple[int, str]] = []
        matches: list[tuple[int, int, int]] = []  # (end, words, state)
        step, link, size, closing = self.next, self.link, self.len, self.closing
        for a, b in zip(starts[some].tolist(), ends[some].tolist(), strict=True):
            v = l = 0
            for i, c in enumerate(known[a:b].tolist(), a + 1):
                u = step[v].get(c)
                if u is None:
                    if l >= LONG:
                        matches.append((i - 1, l, v))
                    while u is None and v > 0:
                        v = link[v]
                        u = step[v].get(c)
                    l = size[v]
                v, l = u, l + 1
                if closing[v]:
                    places += [(i - k, self.labels[t]) for k, t in closing[v] if k <= l]
            if l >= LONG:
                matches.append((b, l, v))
        return Scan(n, sorted(places), self._chained(matches) if matches else [])

    def _chained(self, matches: list[tuple[int, int, int]]) -> list[Span]:
        """Of each template the best chains of matches, and of these the ones that no better template's span holds."""
        nodes: dict[int, list[Span]] = {}
        for end, l, v in matches:
            for t, places in self.ends[v].items():
                if t >= self.phrases:
                    nodes.setdefault(t, []).extend(Span(t, end - l, end, to - l, to, l) for to in places)
        found = [s for t, own in nodes.items() for s in self._best(own) if s.matched >= min(COVERED, self.sizes[t])]
        out: list[Span] = []
        # The better spans that lie in no other: by rising starts, so by rising ends.
        starts: list[int] = []
        ends: list[int] = []

        def cover(s: Span) -> None:
            i = bisect_right(starts, s.start)
            if i and ends[i - 1] >= s.end:
                return
            first = i - 1 if i and starts[i - 1] == s.start else i
            last = bisect_right(ends, s.end)
            starts[first : max(first, last)], ends[first : max(first, last)] = [s.start], [s.end]

        for _, equal in groupby(sorted(found, key=lambda s: (-s.matched, s.template, s.start)), key=lambda s: s.matched):
            held = lambda s: (i := bisect_right(starts, s.start)) > 0 and ends[i - 1] >= s.end
            new = [s for s in equal if not held(s)]
            for s in new:
                cover(s)
            out += new
        return sorted(out, key=lambda s: (s.start, s.template))

    def _best(self, nodes: list[Span]) -> list[Span]:
        """Chains of one template's matches, by how many words they cover; each match is in one, and chains don't overlap.

        A match follows another that ends before it in both the text and the template, with at most GAP words between (words
        of both are taken off the later one). ``nodes`` come by their ends in the text, so only those near are looked at.
        """
        score, back = [0] * len(nodes), [-1] * len(nodes)
        for i, x in enumerate(nodes):
            score[i] = x.matched
            for j in range(i - 1, -1, -1):
                y = nodes[j]
                if y.end < x.start - GAP:
                    break
                over = max(0, y.end - x.start, y.to - x.at)
                gap = x.at + over - y.to
                if over < x.matched and y.end < x.end and y.to < x.to and 0 <= gap <= GAP and x.start + over - y.end <= GAP and score[j] + x.matched - over > score[i]:
                    score[i], back[i] = score[j] + x.matched - over, j
        used, out = [False] * len(nodes), []
        starts: list[int] = []  # of ``out``, whose spans don't overlap
        ends: list[int] = []
        for i in sorted(range(len(nodes)), key=lambda i: (-score[i], i)):
            chain, j = [], i
            while j >= 0 and not used[j]:
                chain.append(j)
                j = back[j]
            if not chain or j >= 0:  # what it goes on from is part of a better chain
                continue
            for j in chain:
                used[j] = True
            first, last = nodes[chain[-1]], nodes[i]
            new = Span(last.template, first.start, last.end, first.at, last.to, score[i])
            i = bisect_right(starts, new.start)
            if not (i and ends[i - 1] > new.start) and not (i < len(starts) and starts[i] < new.end):
                starts.insert(i, new.start)
                ends.insert(i, new.end)
                out.append(new)
        return out


@functools.cache
def automaton() -> Automaton:
    return Automaton(PHRASES, TEMPLATES)


def scans(df: DataFrame, text: str = "text") -> DataFrame:
    """``df`` with ``spans``: label, template, start and end word, first template word, matched words."""
    span = T.StructType([T.StructField("label", T.StringType()), *(T.StructField(x, T.IntegerType()) for x in Span._fields)])
    df = df.drop("spans")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        made = automaton()
        kind = pa.list_(pa.struct([("label", pa.string()), *((x, pa.int32()) for x in Span._fields)]))
        for batch in slices(batches, text):
            rows = [[{"label": made.labels[s.template], **s._asdict()} for s in made.scan(x).spans] for x in texts(batch, text)]
            yield append(batch, spans=pa.array(rows, kind))

    return df.mapInArrow(run, T.StructType([*df.schema.fields, T.StructField("spans", T.ArrayType(span))]))


RESULT = {"doc_id": pa.int64(), "n_words": pa.int64(), "n_base": pa.int64(), "first_word": pa.int64(), "last_word": pa.int64(), "base_labels": pa.string(), "labels": pa.string(), "score": pa.float64(), "spans": pa.int64(), "covered_words": pa.int64()}


def licenses(docs: DataFrame) -> DataFrame:
    """One row for each document: what the scan found, with RESULT's columns."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        made = automaton()
        for batch in slices(batches):
            rows = []
            for doc_id, text in zip(batch["doc_id"].to_pylist(), texts(batch), strict=True):
                s = made.scan(text)
                base = {label for _, label in s.places}
                best = max((x.matched for x in s.spans), default=0)
                score = max(0.5 if base else 0.0, min(1.0, best / SURE))
                if base and best:
                    score = min(1.0, 0.5 + best / SURE / 2)
                both = base | {made.labels[x.template] for x in s.spans}
                first, last = (s.places[0][0], s.places[-1][0]) if s.places else (None, None)
                rows.append((doc_id, s.n_words, len(s.places), first, last, ",".join(sorted(base)), ",".join(sorted(both)), score, len(s.spans), sum(x.matched for x in s.spans)))
            yield pa.RecordBatch.from_arrays([pa.array(x, k) for x, k in zip(zip(*rows, strict=True), RESULT.values(), strict=True)], [*RESULT])

    kinds = {pa.int64(): "long", pa.string(): "string", pa.float64(): "double"}
    return docs.select(docs["doc_id"].cast("long").alias("doc_id"), docs["text"].cast("string").alias("text")).mapInArrow(run, ", ".join(f"{k} {kinds[v]}" for k, v in RESULT.items()))


def op8_license_automaton(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses(spark.read.parquet(f"{sf_dir}/documents.parquet"))
