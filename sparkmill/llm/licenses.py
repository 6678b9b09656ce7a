"""License scans by patience alignment.

A template is aligned with a stretch of the text: words that occur once in both are anchors,
the longest increasing subsequence of their places is kept, and the gaps between kept
anchors are aligned the same way, where more words are unique; equal words at a gap's ends
count as well.  Coverage is matched template words over template words.

Licenses differ in a word or two, so a template also names its deciding words (a phrase of it: the
license's name, version, terms), all of which have to be matched.  Of templates that match
over half of the same words of a text, the one that matches more of its words is kept, then the better
covered, then the one in fewer words of the text: a notice that adds a word to another's is told from it.

A notice is not reported where one of the three words before it in its sentence denies it ("not released
under ...", "modified MIT License").  The names of licenses, their SPDX identifiers and abbreviations are
templates as well, whose words have to stand side by side.

A text is aligned in windows of 1.5 template lengths, half a length apart, so that every
stretch of one length lies whole in one.  A window is aligned if it holds half the words of the
template that the coverage asks (a notice spread over two lengths has them in some window: a
bound, not a guess) and is then extended by half a length to either side while that matches
more of the template: one word in four of those added, or most of what is missing.  Covered
windows are taken by coverage, none over another; what lies between is scanned again, so a
notice that shared its windows with a copy is found as well.

Edge cases: a null, empty or wordless text has no matches; of overlapping windows with equal
coverage the earliest is kept; null ids and repeated rows are scanned row by row; other columns take
no part; an empty table gives no rows.
"""

from __future__ import annotations

from bisect import bisect_left
from collections import Counter
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import slices

COVERAGE = 0.8


class Template(NamedTuple):
    name: str
    license: str
    text: str
    deciding: str = ""
    #: Whether the deciding words have to stand side by side in the text, as the names of licenses do.
    tight: bool = False


# Public license notices.
_APACHE = (
    '(the "License"); you may not use this file except in compliance with the License. '
    "You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0 Unless required by applicable law or agreed to in writing, "
    'software distributed under the License is distributed on an "AS IS" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied. '
    "See the License for the specific language governing permissions and limitations under the License."
)
_GPL = (
    "This program is free software: you can redistribute it and/or modify it under the terms of the {0} as published by "
    "the Free Software Foundation, either version {1} of the License, or (at your option) any later version. This program is distributed in the hope "
    "that it will be useful, but WITHOUT ANY WARRANTY; without even the implied warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE. "
    "See the {0} for more details. You should have received a copy of the {0} along with this program."
)
_MIT = (
    'Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the "Software"), '
    "to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, "
    "and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the following conditions: "
    "The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software. "
    'THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, '
    "FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER "
    "LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE."
)
_BSD = (
    "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met: "
    "1. Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer. "
    "2. Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer in the documentation "
    "and/or other materials provided with the distribution. {0}"
    'THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS "AS IS" AND ANY EXPRESS OR IMPLIED WARRANTIES, INCLUDING, BUT NOT LIMITED TO, '
    "THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE DISCLAIMED. IN NO EVENT SHALL THE COPYRIGHT HOLDER OR CONTRIBUTORS BE LIABLE "
    "FOR ANY DIRECT, INDIRECT, INCIDENTAL, SPECIAL, EXEMPLARY, OR CONSEQUENTIAL DAMAGES (INCLUDING, BUT NOT LIMITED TO, PROCUREMENT OF SUBSTITUTE GOODS OR SERVICES; "
    "LOSS OF USE, DATA, OR PROFITS; OR BUSINESS INTERRUPTION) HOWEVER CAUSED AND ON ANY THEORY OF LIABILITY, WHETHER IN CONTRACT, STRICT LIABILITY, OR TORT "
    "(INCLUDING NEGLIGENCE OR OTHERWISE) ARISING IN ANY WAY OUT OF THE USE OF THIS SOFTWARE, EVEN IF ADVISED OF THE POSSIBILITY OF SUCH DAMAGE."
)
_BSD_THIRD = (
    "3. Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from this software "
    "without specific prior written permission. "
)
_ISC = (
    "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the above copyright notice "
    'and this permission notice appear in all copies. THE SOFTWARE IS PROVIDED "AS IS" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE '
    "INCLUDING ALL IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL THE AUTHOR BE LIABLE FOR ANY SPECIAL, DIRECT, INDIRECT, OR CONSEQUENTIAL DAMAGES "
    "OR ANY DAMAGES WHATSOEVER RESULTING FROM LOSS OF USE, DATA OR PROFITS, WHETHER IN AN ACTION OF CONTRACT, NEGLIGENCE OR OTHER TORTIOUS ACTION, "
    "ARISING OUT OF OR IN CONNECTION WITH THE USE OR PERFORMANCE OF THIS SOFTWARE."
)
_MPL = (
    "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was not distributed with this file, "
    "You can obtain one at https://mozilla.org/MPL/2.0/."
)
_GNU = [("gpl", "GNU General Public License", ("1", "2", "3")), ("lgpl", "GNU Lesser General Public License", ("2.1", "3")), ("lgpl", "GNU Library General Public License", ("2",)), ("agpl", "GNU Affero General Public License", ("3",))]
_UNLICENSE = (
    "This is free and unencumbered software released into the public domain. Anyone is free to copy, modify, publish, use, compile, sell, or distribute "
    "this software, either in source code form or as a compiled binary, for any purpose, commercial or non-commercial, and by any means."
)
_ZLIB = (
    "This software is provided 'as-is', without any express or implied warranty. In no event will the authors be held liable for any damages arising from "
    "the use of this software. Permission is granted to anyone to use this software for any purpose, including commercial applications, and to alter it and "
    "redistribute it freely, subject to the following restrictions: 1. The origin of this software must not be misrepresented; you must not claim that you "
    "wrote the original software. If you use this software in a product, an acknowledgment in the product documentation would be appreciated but is not required. "
    "2. Altered source versions must be plainly marked as such, and must not be misrepresented as being the original software. "
    "3. This notice may not be removed or altered from any source distribution."
)
_BSL = (
    'Permission is hereby granted, free of charge, to any person or organization obtaining a copy of the software and accompanying documentation covered by this license (the "Software") '
    "to use, reproduce, display, distribute, execute, and transmit the Software, and to prepare derivative works of the Software, and to permit third-parties to whom the Software "
    "is furnished to do so, all subject to the following:"
)
_EPL = "This program and the accompanying materials are made available under the terms of the Eclipse Public License {0} which is available at"
_CC_TERMS = {"BY": "Attribution", "BY-SA": "Attribution-ShareAlike", "BY-NC": "Attribution-NonCommercial", "BY-ND": "Attribution-NoDerivatives", "BY-NC-SA": "Attribution-NonCommercial-ShareAlike", "BY-NC-ND": "Attribution-NonCommercial-NoDerivatives"}
_CC_PORTS = {"3.0": "Unported", "4.0": "International"}
_SPDX = ("0BSD", "AFL-3.0", "Apache-1.1", "Apache-2.0", "Artistic-2.0", "BSD-2-Clause", "BSD-3-Clause", "BSL-1.0", "CC0-1.0", "CDDL-1.0", "ECL-2.0", "EPL-1.0", "EPL-2.0", "EUPL-1.2", "ISC", "MIT", "MPL-1.1", "MPL-2.0", "MS-PL", "NCSA", "OFL-1.1", "PostgreSQL", "Unlicense", "WTFPL", "Zlib")
#: Words that, up to three before a notice in its sentence, say that it does not hold.
_DENIALS = frozenset(b"not never no non isn't aren't wasn't weren't neither nor without except unlike modified".split())
# End of fixed values.


def _numbered(version: str) -> str:
    return version if "." in version else f"{version}.0"


def _templates() -> list[Template]:
    out = [
        Template("apache-2.0-header", "apache-2.0", f"Licensed under the Apache License, Version 2.0 {_APACHE}", "Apache License, Version 2.0"),
        Template("mit-text", "mit", _MIT),
        Template("bsd-2-clause-text", "bsd-2-clause", _BSD.format("")),
        Template("bsd-3-clause-text", "bsd-3-clause", _BSD.format(_BSD_THIRD), "Neither the name of"),
        Template("isc-text", "isc", _ISC),
        Template("mpl-2.0-header", "mpl-2.0", _MPL, "Mozilla Public License, v. 2.0"),
    ]
    for version in ("1.1", "2.0"):
        out.append(Template(f"apache-{version}", f"apache-{version}", f"Licensed under the Apache License, Version {version}.", f"Apache License, Version {version}"))
    for short, name in (("mit", "MIT"), ("isc", "ISC"), ("bsd", "BSD"), ("bsd-2-clause", "BSD 2-Clause"), ("bsd-3-clause", "BSD 3-Clause")):
        out.append(Template(short, short, f"Released under the {name} License.", f"{name} License"))
    for terms in ("BY", "BY-SA", "BY-NC", "BY-ND", "BY-NC-SA", "BY-NC-ND"):
        for version in ("3.0", "4.0"):
            name = f"cc-{terms.lower()}-{version}"
            out.append(Template(name, name, f"Licensed under CC {terms} {version}.", f"CC {terms} {version}"))
    for short, name, versions in _GNU:
        for version in versions:
            own = f"{short}-{_numbered(version)}"
            out.append(Template(own, own, f"This work is licensed under the {name}, version {version}.", f"{name}, version {version}"))
            out.append(Template(f"{own}-header", own, _GPL.format(name, version), f"version {version} of the License"))
    return out + _full_texts() + _names()


def _full_texts() -> list[Template]:
    out = [Template("unlicense-text", "unlicense", _UNLICENSE, "free and unencumbered software"), Template("zlib-text", "zlib", _ZLIB, "must not be misrepresented"), Template("bsl-1.0-text", "bsl-1.0", _BSL, "person or organization")]
    return out + [Template(f"epl-{v}-header", f"epl-{v}", _EPL.format(v), f"Eclipse Public License {v}") for v in ("1.0", "2.0")]


def _names() -> list[Template]:
    """Licenses by name alone, by SPDX identifier and by abbreviation: all words decide, side by side."""
    named = lambda name, license, text: Template(name, license, text, text, True)
    out = [named("mit-name", "mit", "MIT License"), named("cc0-name", "cc0-1.0", "CC0 1.0 Universal"), named("mpl-2.0-name", "mpl-2.0", "Mozilla Public License 2.0"), named("bsl-1.0-name", "bsl-1.0", "Boost Software License Version 1.0")]
    for version in ("1.1", "2.0"):
        out += [named(f"apache-{version}-{k}", f"apache-{version}", text) for k, text in (("name", f"Apache License {version}"), ("version", f"Apache License Version {version}"))]
    for terms, name in _CC_TERMS.items():
        for version, port in _CC_PORTS.items():
            own = f"cc-{terms.lower()}-{version}"
            out.append(Template(f"{own}-notice", own, f"This work is licensed under a Creative Commons {name} {version} {port} License.", f"Creative Commons {name} {version} {port} License"))
            out += [named(f"{own}-{k}", own, text) for k, text in (("name", f"CC {terms} {version}"), ("id", f"CC-{terms}-{version}"))]
            out.append(named(f"{own}-spdx", own, f"SPDX-License-Identifier: CC-{terms}-{version}"))
    for short, _, versions in _GNU:
        for version in versions:
            own, upper = f"{short}-{_numbered(version)}", short.upper()
            forms = {"v": f"{upper} v{version}", "joined": f"{upper}v{version}", "id": f"{upper}-{_numbered(version)}", "version": f"{upper} version {version}"}
            out += [named(f"{own}-{k}", own, text) for k, text in forms.items()]
            out += [named(f"{own}-spdx{end}", own, f"SPDX-License-Identifier: {upper}-{_numbered(version)}{end}") for end in ("", "-only", "-or-later")]
    return out + [named(f"{i.lower()}-spdx", i.lower(), f"SPDX-License-Identifier: {i}") for i in _SPDX]


TEMPLATES = _templates()

_EDGE = b".,;:!?\"'()[]{}<>*#/"


def words(text: str) -> list[bytes]:
    """Lower-case words without the punctuation at their ends; words of punctuation alone go."""
    return [w for w in (x.strip(_EDGE) for x in text.lower().encode().split()) if w]


def _ends(text: str) -> list[bool]:
    """Whether each of the words ends its sentence."""
    return [x.rstrip(b"\"')]}>*")[-1:] in (b".", b"!", b"?", b";") for x in text.lower().encode().split() if x.strip(_EDGE)]


def increasing(ys: list[int]) -> list[int]:
    """Indices of a longest increasing subsequence (patience piles)."""
    tops, at, back = [], [], []
    for i, y in enumerate(ys):
        k = bisect_left(tops, y)
        back.append(at[k - 1] if k else -1)
        if k == len(tops):
            tops.append(y)
            at.append(i)
        else:
            tops[k], at[k] = y, i
    out, i = [], at[-1] if at else -1
    while i >= 0:
        out.append(i)
        i = back[i]
    return out[::-1]


def align(a: list, b: list) -> list[tuple[int, int]]:
    """Matched places (i in a, j in b), ascending in both."""
    out, gaps = [], [(0, len(a), 0, len(b))]
    while gaps:
        i, m, j, n = gaps.pop()
        while i < m and j < n and a[i] == b[j]:
            out.append((i, j))
            i, j = i + 1, j + 1
        while i < m and j < n and a[m - 1] == b[n - 1]:
            m, n = m - 1, n - 1
            out.append((m, n))
        if i >= m or j >= n:
            continue
        na, nb = Counter(a[i:m]), Counter(b[j:n])
        where = {w: k for k, w in enumerate(b[j:n], j) if nb[w] == 1}
        unique = [(k, where[w]) for k, w in enumerate(a[i:m], i) if na[w] == 1 and w in where]
        anchors = [unique[k] for k in increasing([y for _, y in unique])]
        if not anchors:
            continue
        out += anchors
        for (x0, y0), (x1, y1) in zip([(i - 1, j - 1), *anchors], [*anchors, (m, n)]):
            if x0 + 1 < x1 and y0 + 1 < y1:
                gaps.append((x0 + 1, x1, y0 + 1, y1))
    return sorted(out)


class Found(NamedTuple):
    matched: int
    lo: int
    hi: int
    places: frozenset


class Scanner:
    def __init__(self, templates: list[Template], coverage: float):
        self.coverage = coverage
        self.templates = [(t, words(t.text)) for t in templates]
        self.vocabulary = {w: i for i, w in enumerate(sorted({w for _, t in self.templates for w in t}), 1)}
        self.member, self.count, self.decides, self.must = [], [], [], []
        for given, t in self.templates:
            ids = np.array([self.vocabulary[w] for w in t])
            self.member.append(np.isin(np.arange(len(self.vocabulary) + 1), ids))
            self.count.append(np.bincount(ids, minlength=len(self.vocabulary) + 1))
            phrase = words(given.deciding)
            at = next((i for i in range(len(t)) if t[i : i + len(phrase)] == phrase), None)
            if at is None:
                raise ValueError(f"template {given.name} lacks its deciding words")
            self.decides.append(set(range(at, at + len(phrase))))
            self.must.append(np.unique(ids[at : at + len(phrase)]))
        # Templates without deciding words have a word that every text has: number 0, of words in no template.
        held = [m if len(m) else np.zeros(1, np.int64) for m in self.must]
        self.musts, self.first = np.concatenate(held), np.cumsum([0, *map(len, held)][:-1])

    def scan(self, text: str | None):
        """(template, matched words, template words, first word, end word) of every covered window, the best of those over the same words."""
        ws = words(text or "")
        if not ws:
            return []
        ids = np.fromiter((self.vocabulary.get(w, 0) for w in ws), np.int32, len(ws))
        present = np.zeros(len(self.vocabulary) + 1, bool)
        present[ids] = True
        present[0] = True
        every: list[tuple[int, Found]] = []
        for k in np.flatnonzero(np.logical_and.reduceat(present[self.musts], self.first)).tolist():
            if np.count_nonzero(present & self.member[k]) < self.coverage * np.count_nonzero(self.member[k]) / 2:
                continue
            hits = np.r_[0, np.cumsum(self.member[k][ids])]
            rest = [(0, len(ws))]
            while rest:
                lo, hi = rest.pop()
                some = self._covered(k, ws, ids, hits, lo, hi)
                if some:
                    every += [(k, x) for x in some]
                    edges = [lo, *(e for x in some for e in (x.lo, x.hi)), hi]
                    rest += zip(edges[::2], edges[1::2])
        if not every:
            return []
        size = lambda k: len(self.templates[k][1])
        kept: list[tuple[int, Found]] = []
        for k, x in sorted(every, key=lambda y: (-y[1].matched, -y[1].matched / size(y[0]), y[1].hi - y[1].lo, y[1].lo, y[0])):
            if all(2 * len(x.places & y.places) <= min(x.matched, y.matched) for _, y in kept if x.lo < y.hi and y.lo < x.hi):
                kept.append((k, x))
        ends = _ends(text)
        kept = [(k, x) for k, x in kept if not self._denied(ws, ends, x.lo)]
        return [(self.templates[k][0], x.matched, size(k), x.lo, x.hi) for k, x in sorted(kept, key=lambda y: (y[1].lo, y[0]))]

    @staticmethod
    def _denied(ws: list[bytes], ends: list[bool], lo: int) -> bool:
        """Whether one of the three words before a notice, in its sentence, denies it."""
        for i in range(lo - 1, max(lo - 4, -1), -1):
            if ends[i]:
                return False
            if ws[i] in _DENIALS:
                return True
        return False

    def _covered(self, k: int, ws: list[bytes], ids: np.ndarray, hits: np.ndarray, lo: int, hi: int) -> list[Found]:
        """Covered windows inside ws[lo:hi], ascending and apart."""
        t, count = self.templates[k][1], self.count[k]
        m, most = len(t), self.coverage * len(t)
        if hits[hi] - hits[lo] < most:
            return []
        size, step = m + (m + 1) // 2, max(1, m // 2)
        start = np.arange(lo, max(hi - m // 2, lo) + 1, step)
        inside = hits[np.minimum(start + size, hi)] - hits[start]
        met = set()
        for s in start[inside >= np.ceil(most / 2)].tolist():
            e = min(s + size, hi)
            if np.minimum(np.bincount(ids[s:e], minlength=len(count)), count).sum() < most / 2:
                continue
            found = self._extended(k, ws, s, e, step, lo, hi)
            if found is not None and found.matched >= most:
                met.add(found)
        out: list[Found] = []
        for x in sorted(met, key=lambda x: (-x.matched, x.lo, x.hi)):
            i = bisect_left(out, x.lo, key=lambda y: y.lo)
            if (i == 0 or out[i - 1].hi <= x.lo) and (i == len(out) or x.hi <= out[i].lo):
                out.insert(i, x)
        return out

    def _extended(self, k: int, ws: list[bytes], s: int, e: int, step: int, lo: int, hi: int) -> Found | None:
        """The alignment with the window s:e, widened while it gains; none if a deciding word is not matched."""
        t = self.templates[k][1]
        pairs = align(t, ws[s:e])
        grown = True
        while grown and len(pairs) < len(t):
            grown = False
            gain = max(1, min((step + 3) // 4, int(self.coverage * (len(t) - len(pairs)))))
            for s1, e1 in ((s, min(e + step, hi)), (max(s - step, lo), e)):
                if (s1, e1) != (s, e):
                    more = align(t, ws[s1:e1])
                    if len(more) >= len(pairs) + gain:
                        pairs, s, e, grown = more, s1, e1, True
                        break
        found = [(i, s + j) for i, j in pairs]
        short = len(t) - len(pairs)
        if short and len(pairs) >= self.coverage * len(t):  # without the neighbours' words more of its own are unique
            a, b = found[0][1], found[-1][1] + 1
            for s, e in ((a, min(b + short, hi)), (max(a - short, lo), b)):
                more = align(t, ws[s:e])
                if len(more) > len(found):
                    found = [(i, s + j) for i, j in more]
        if not found or not self.decides[k] <= {i for i, _ in found}:
            return None
        if self.templates[k][0].tight:
            places = [j for i, j in found if i in self.decides[k]]
            if places[-1] - places[0] >= len(places):
                return None
        return Found(len(found), found[0][1], found[-1][1] + 1, frozenset(j for _, j in found))


def templates_of(rows: DataFrame) -> list[Template]:
    """Templates from a table (name, license, text, deciding, and tight where it has that column); a few hundred rows, as each text is held against each."""
    tight = F.col("tight") if "tight" in rows.columns else F.lit(False)
    return [Template(r["name"], r["license"], r["text"], r["deciding"] or "", bool(r["tight"])) for r in rows.select("name", "license", "text", "deciding", tight.alias("tight")).collect()]


def template_table(spark, templates: list[Template] | None = None) -> DataFrame:
    """The templates as a table, to be changed and given back by templates_of."""
    return spark.createDataFrame(TEMPLATES if templates is None else templates, "name string, license string, text string, deciding string, tight boolean")


def scan(docs: DataFrame, templates: list[Template] | None = None, coverage: float = COVERAGE) -> DataFrame:
    """doc_id, license, template, coverage, matched_words, template_words, word_lo, word_hi: one row per document and covered stretch."""
    templates = TEMPLATES if templates is None else templates
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    schema = pa.schema([("doc_id", pa.int64()), ("license", pa.string()), ("template", pa.string()), ("coverage", pa.float64()), *((c, pa.int64()) for c in ("matched_words", "template_words", "word_lo", "word_hi"))])

    def run(batches):
        scanner = Scanner([Template(*t) for t in templates], coverage)
        for batch in slices(batches, "text"):
            out = [(i, t.license, t.name, n / m, n, m, lo, hi) for i, text in zip(*(c.to_pylist() for c in batch.columns)) for t, n, m, lo, hi in scanner.scan(text)]
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*out) if out else [[]] * len(schema), schema)], schema=schema)

    return rows.mapInArrow(run, "doc_id long, license string, template string, coverage double, matched_words long, template_words long, word_lo long, word_hi long")
