"""License scans by patience alignment.

The words of a text are aligned with those of each license template:

1. Anchors are the words that occur once in the template, wherever they occur
   in the text.  One pass of patience piles over the whole text finds the
   copies: a copy's core is the first chain of anchors, increasing in both,
   that is long enough for ``least`` (of such chains the one that starts last).
   Other words in between, however many, do not end a chain; cores that go on
   from one another in the template are one copy.
2. A copy reaches to the next one's core.  The nearest longest chains of the
   template's head and tail words outside the core join it; the gaps between
   its anchors are aligned in the same way: equal heads and tails, words that
   occur once in both, the longest increasing subsequence of their positions,
   and so on in the gaps between those.  A gap without anchors ends there.
3. Coverage is the share of the template's words that are aligned.  Words at an
   end that lie further off than the template is long are left out where the
   others reach ``least`` without them.
4. The words that tell a license from its siblings (``REQUIRED``: names,
   versions, variants) must be aligned, and as close together as in the template.

All work on a text is in the task that holds it; nothing is shuffled.
"""

from __future__ import annotations

import re
from bisect import bisect_left
from collections import Counter

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import texts_of

_AS_IS = (
    "THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS \"AS IS\" AND ANY EXPRESS OR IMPLIED WARRANTIES, INCLUDING, BUT NOT LIMITED TO, "
    "THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE DISCLAIMED. IN NO EVENT SHALL THE COPYRIGHT HOLDER OR CONTRIBUTORS BE LIABLE "
    "FOR ANY DIRECT, INDIRECT, INCIDENTAL, SPECIAL, EXEMPLARY, OR CONSEQUENTIAL DAMAGES (INCLUDING, BUT NOT LIMITED TO, PROCUREMENT OF SUBSTITUTE GOODS OR SERVICES; "
    "LOSS OF USE, DATA, OR PROFITS; OR BUSINESS INTERRUPTION) HOWEVER CAUSED AND ON ANY THEORY OF LIABILITY, WHETHER IN CONTRACT, STRICT LIABILITY, OR TORT "
    "(INCLUDING NEGLIGENCE OR OTHERWISE) ARISING IN ANY WAY OUT OF THE USE OF THIS SOFTWARE, EVEN IF ADVISED OF THE POSSIBILITY OF SUCH DAMAGE."
)
_BSD = "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met"
_BSD_TWO = (
    f"{_BSD}: 1. Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer. "
    "2. Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer "
    "in the documentation and/or other materials provided with the distribution."
)

# Short notices by which licenses are commonly applied, and whole texts.
TEMPLATES: dict[str, str] = {
    "Apache-2.0": "Licensed under the Apache License, Version 2.0",
    "Apache-2.0-notice": (
        "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in compliance with the License. "
        "You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0 Unless required by applicable law or agreed to in writing, "
        "software distributed under the License is distributed on an \"AS IS\" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied."
    ),
    "MIT": "Released under the MIT License",
    "MIT-grant": (
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files, "
        "to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, "
        "and/or sell copies of the Software"
    ),
    "GPL-3.0": "This work is licensed under the GNU General Public License, version 3",
    "CC-BY-NC-4.0": "Licensed under CC BY-NC 4.0",
    "CC-BY-4.0": "This work is licensed under a Creative Commons Attribution 4.0 International License",
    "CC-BY-SA-4.0": "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License",
    "GPL-2.0": "This work is licensed under the GNU General Public License, version 2",
    "LGPL-3.0": "This work is licensed under the GNU Lesser General Public License, version 3",
    "AGPL-3.0": "This work is licensed under the GNU Affero General Public License, version 3",
    "MIT-text": (
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the \"Software\"), "
        "to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, "
        "and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the following conditions: "
        "The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software. "
        "THE SOFTWARE IS PROVIDED \"AS IS\", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, "
        "FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, "
        "WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE."
    ),
    "BSD": _BSD,  # the opening of any variant
    "BSD-2-Clause": f"{_BSD_TWO} {_AS_IS}",
    "BSD-3-Clause": (
        f"{_BSD_TWO} 3. Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products "
        f"derived from this software without specific prior written permission. {_AS_IS}"
    ),
    "MPL-2.0": "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0",
}

#: Word sequences of a template that an occurrence must have; ``_`` is any word, or none.
REQUIRED: dict[str, list[str]] = {
    "Apache-2.0": ["apache license _ 2.0"],
    "Apache-2.0-notice": ["apache license _ 2.0"],
    "MIT": ["mit license"],
    "MIT-grant": ["deal in the software"],
    "GPL-3.0": ["gnu general public license", "public license _ 3"],
    "CC-BY-NC-4.0": ["cc by-nc 4.0"],
    "CC-BY-4.0": ["creative commons attribution 4.0"],
    "MPL-2.0": ["mozilla public license _ 2.0"],
    "CC-BY-SA-4.0": ["creative commons attribution-sharealike 4.0"],
    "GPL-2.0": ["gnu general public license", "public license _ 2"],
    "LGPL-3.0": ["gnu lesser general public license", "public license _ 3"],
    "AGPL-3.0": ["gnu affero general public license", "public license _ 3"],
    "MIT-text": ["deal in the software", "shall be included in all copies"],
    "BSD-2-Clause": ["provided with the distribution this software"],
    "BSD-3-Clause": ["neither the name"],
}

_WORD = re.compile(r"\w+(?:[.-]\w+)*")

Pair = tuple[int, int]


def words_of(text: str) -> list[str]:
    return _WORD.findall(text.lower())


def longest_increasing(values: list[int]) -> list[int]:
    """Indices of a longest strictly increasing subsequence (the first found by patience piles)."""
    tops: list[int] = []
    pile: list[int] = []
    behind = [-1] * len(values)
    for i, v in enumerate(values):
        k = bisect_left(tops, v)
        behind[i] = pile[k - 1] if k else -1
        tops[k:], pile[k:] = ([v], [i]) if k == len(tops) else ([v, *tops[k + 1 :]], [i, *pile[k + 1 :]])
    out, i = [], pile[-1] if pile else -1
    while i >= 0:
        out.append(i)
        i = behind[i]
    return out[::-1]


def patience(a: list[str], b: list[str]) -> list[Pair]:
    """Aligned positions (in ``a``, in ``b``), increasing in both."""
    out: list[Pair] = []
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
        place = {w: i for i, w in enumerate(a[a0:a1], a0) if in_a[w] == 1}
        anchors = [(place[w], j) for j, w in enumerate(b[b0:b1], b0) if in_b[w] == 1 and w in place]
        kept = [anchors[i] for i in longest_increasing([i for i, _ in anchors])]
        out += kept
        edges = [(a0 - 1, b0 - 1), *kept, (a1, b1)] if kept else []
        todo += [(i + 1, k, j + 1, m) for (i, j), (k, m) in zip(edges, edges[1:], strict=False)]
    return sorted(out)


class Piles:
    """Patience piles that grow by one (place in the text, place in the template) at a time."""

    def __init__(self) -> None:
        self.tops: list[int] = []
        self.ends: list[tuple] = []  # of each pile the newest (text, template, what it goes on from)

    def push(self, x: int, i: int) -> int:
        """The length of the longest chain that ends here; of such chains the one that starts last is held."""
        k = bisect_left(self.tops, i)
        end = (x, i, self.ends[k - 1] if k else None)
        self.tops[k : k + 1], self.ends[k : k + 1] = [i], [end]
        return k + 1

    def chain(self, length: int) -> list[Pair]:
        out, end = [], self.ends[length - 1] if length else None
        while end:
            out.append(end[:2])
            end = end[2]
        return out[::-1]


def places_of(template: list[str]) -> dict[str, list[int]]:
    """Positions of each word, last first: a chain takes one of them at most."""
    out: dict[str, list[int]] = {}
    for i in range(len(template) - 1, -1, -1):
        out.setdefault(template[i], []).append(i)
    return out


def nearest_chain(words: list[str], template: list[str]) -> list[Pair]:
    """A longest common subsequence; of those the one that ends first."""
    piles, places, best = Piles(), places_of(template), []
    for x, w in enumerate(words):
        for i in places.get(w, ()):
            if (k := piles.push(x, i)) > len(best):
                best = piles.chain(k)
        if len(best) == len(template):
            break
    return best


class Template:
    """A template's words, its anchors and what an occurrence must have."""

    def __init__(self, text: str, required: list[str], least: float):
        self.words = words_of(text)
        self.set, self.least, n = frozenset(self.words), least, len(self.words)
        self.lost = next((k for k in range(n, -1, -1) if (n - k) / n >= least), 0) if n else 0  # words that may be missing
        self.places = {w: at for w, at in places_of(self.words).items() if len(at) == 1}
        self.need = len(self.places) - self.lost
        if 2 * self.need < len(self.places) or self.need < 1:  # too few anchors: every word is one
            self.places, self.need = places_of(self.words), max(1, n - self.lost)
        self.required = [self._spots(r.split()) for r in required]
        self.must = frozenset(w for r in required for w in r.split()) - {"_"}

    def _spots(self, phrase: list[str]) -> list[list[int]]:
        """Where the template has the phrase: the positions of its words, without ``_``."""
        inside = [i for i, w in enumerate(phrase) if w != "_"]
        return [[s + i for i in inside] for s in range(len(self.words) - len(phrase) + 1) if all(self.words[s + i] == phrase[i] for i in inside)]

    def cores(self, words: list[str]) -> list[list[Pair]]:
        """The anchors of each copy."""
        out: list[list[Pair]] = []
        piles = Piles()
        for x, w in enumerate(words):
            for i in self.places.get(w, ()):
                piles.push(x, i)
            if len(piles.tops) >= self.need:
                core, piles = piles.chain(self.need), Piles()
                if out and out[-1][-1][1] < core[0][1]:
                    out[-1] += core
                else:
                    out.append(core)
        return out

    def occurrences(self, words: list[str], at: list[int]) -> list[list[Pair]]:
        """Aligned positions of each copy; ``at`` has the words' numbers in the whole text."""
        out, left, cores = [], 0, self.cores(words)
        for c, core in enumerate(cores):
            right = cores[c + 1][0][0] if c + 1 < len(cores) else len(words)
            if c:  # a head lies after the core before began, so each word is looked at a few times only
                left = max(left, cores[c - 1][0][0])
            (x0, i0), (x1, i1) = core[0], core[-1]
            head = [(x0 - 1 - x, i0 - 1 - i) for x, i in nearest_chain(words[left:x0][::-1], self.words[:i0][::-1])][::-1]
            tail = [(x1 + 1 + x, i1 + 1 + i) for x, i in nearest_chain(words[x1 + 1 : right], self.words[i1 + 1 :])]
            kept = [*head, *core, *tail]
            pairs = kept[:]
            for (x, i), (y, j) in zip(kept, kept[1:], strict=False):
                if y > x + 1 and j > i + 1:
                    pairs += [(x + 1 + p, i + 1 + q) for p, q in patience(words[x + 1 : y], self.words[i + 1 : j])]
            pairs = self._trimmed(sorted(pairs), at)
            if len(pairs) / len(self.words) >= self.least and self._told(pairs, at):
                out.append(pairs)
                left = pairs[-1][0] + 1
        return out

    def _trimmed(self, pairs: list[Pair], at: list[int]) -> list[Pair]:
        room, n = max(30, len(self.words)), len(self.words)
        far = [k for k in range(1, len(pairs)) if at[pairs[k][0]] - at[pairs[k - 1][0]] - 1 > room]
        a, b = 0, len(pairs)
        while far:
            if far[0] - a <= b - far[-1] and (b - far[0]) / n >= self.least:
                a = far.pop(0)
            elif (far[-1] - a) / n >= self.least:
                b = far.pop()
            elif (b - far[0]) / n >= self.least:
                a = far.pop(0)
            else:
                break
        return pairs[a:b]

    def _told(self, pairs: list[Pair], at: list[int]) -> bool:
        place = {i: at[x] for x, i in pairs}

        def held(spot: list[int]) -> bool:
            return all(i in place for i in spot) and all(place[j] - place[i] <= j - i for i, j in zip(spot, spot[1:], strict=False))

        return all(any(map(held, spots)) for spots in self.required)


class Scanner:
    """Templates, ready for texts."""

    def __init__(self, templates: dict[str, str], least: float = 0.8, required: dict[str, list[str]] | None = None):
        names = {name: r for name, r in REQUIRED.items() if templates.get(name) == TEMPLATES[name]} if required is None else required
        self.templates = {name: Template(t, names.get(name, []), least) for name, t in templates.items()}
        self.known = frozenset(w for t in self.templates.values() for w in t.words)

    def scan(self, text: str) -> list[tuple[str, float, int, int]]:
        """(template, coverage, start, stop) in code points, of copies covered by ``least`` or more."""
        at, words, spans = [], [], []
        lower = text.lower()
        if len(lower) != len(text):  # a few letters have longer lower cases
            lower = "".join(c.lower() if len(c.lower()) == 1 else c for c in text)
        known = self.known
        for i, m in enumerate(_WORD.finditer(lower)):
            if m[0] in known:
                at.append(i)
                words.append(m[0])
                spans.append(m.span())
        out = []
        held = set(words)
        for name, template in self.templates.items():
            if not template.words or not template.must <= held or len(template.set - held) > template.lost:
                continue  # each word that doesn't occur leaves one position uncovered, at least
            own = [k for k, w in enumerate(words) if w in template.set]
            for pairs in template.occurrences([words[k] for k in own], [at[k] for k in own]):
                out.append((name, len(pairs) / len(template.words), spans[own[pairs[0][0]]][0], spans[own[pairs[-1][0]]][1]))
        return sorted(out, key=lambda x: (x[2], x[3], x[0]))


def scan_licenses(docs: DataFrame, text_col: str = "text", templates: dict[str, str] | None = None, least: float = 0.8, out_col: str = "licenses", required: dict[str, list[str]] | None = None) -> DataFrame:
    """``docs`` with ``out_col``: the templates found, with coverage and place.

    Null and empty texts have none; a text is scanned whole; repeated
    occurrences are all reported, also of templates that overlap.  ``required``
    has the word sequences without which a template is not reported (by default
    ``REQUIRED``, for templates that are in ``TEMPLATES`` with the same text).
    A column named ``out_col`` is replaced.
    """
    chosen = TEMPLATES if templates is None else templates

    @F.pandas_udf("array<struct<license:string,coverage:double,start:int,stop:int>>")
    def run(column: pd.Series) -> pd.Series:
        scanner = Scanner(chosen, least, required)
        return pd.Series([scanner.scan(t) for t in texts_of(column)], dtype=object)

    return docs.withColumn(out_col, run(F.col(text_col).cast("string")))
