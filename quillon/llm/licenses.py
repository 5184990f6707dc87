"""Licence scans: parts of a text against licence templates by Dice coefficient.

A text's parts are its sentences, lines, paragraphs and the text itself, and runs
of consecutive paragraphs, for notices of several paragraphs inside a longer text;
of overlapping runs the best counts, if no part of it matches as well.  Words are
lower-cased, copyright clauses are left out, and a part matches a template if their
word bigrams, as multisets, have a Dice coefficient of ``threshold`` or more.  A
coefficient t bounds the sizes: of a part with n bigrams only templates with
n * t / (2 - t) to n * (2 - t) / t bigrams can match, and only these are compared.
"""

from __future__ import annotations

import re
from bisect import bisect_left, bisect_right
from collections import Counter
from collections.abc import Iterator
from itertools import accumulate

import pyarrow as pa
import pyspark.sql.types as T
from pyspark.sql import DataFrame

from . import common
from .decontamination import normalised

_BSD_DISCLAIMER = (
    'THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS "AS IS" AND ANY EXPRESS OR IMPLIED WARRANTIES, INCLUDING, BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY'
    " AND FITNESS FOR A PARTICULAR PURPOSE ARE DISCLAIMED. IN NO EVENT SHALL THE COPYRIGHT HOLDER OR CONTRIBUTORS BE LIABLE FOR ANY DIRECT, INDIRECT, INCIDENTAL, SPECIAL, EXEMPLARY, OR"
    " CONSEQUENTIAL DAMAGES (INCLUDING, BUT NOT LIMITED TO, PROCUREMENT OF SUBSTITUTE GOODS OR SERVICES; LOSS OF USE, DATA, OR PROFITS; OR BUSINESS INTERRUPTION) HOWEVER CAUSED AND ON ANY THEORY"
    " OF LIABILITY, WHETHER IN CONTRACT, STRICT LIABILITY, OR TORT (INCLUDING NEGLIGENCE OR OTHERWISE) ARISING IN ANY WAY OUT OF THE USE OF THIS SOFTWARE, EVEN IF ADVISED OF THE POSSIBILITY OF"
    " SUCH DAMAGE."
)

#: Public licence texts and notices (name, text).
TEMPLATES: tuple[tuple[str, str], ...] = (
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0."),
    ("Apache-2.0", "This work is licensed under the Apache License, Version 2.0."),
    (
        "Apache-2.0",
        'Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in compliance with the License. You may obtain a copy of the License at'
        " http://www.apache.org/licenses/LICENSE-2.0 Unless required by applicable law or agreed to in writing, software distributed under the License is distributed on an"
        ' "AS IS" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied. See the License for the specific language governing permissions and limitations under the License.',
    ),
    ("MIT", "Released under the MIT License."),
    ("MIT", "Licensed under the MIT License."),
    ("MIT", "This work is licensed under the MIT License."),
    (
        "MIT",
        'Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the "Software"), to deal in the Software without'
        " restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom"
        " the Software is furnished to do so, subject to the following conditions: The above copyright notice and this permission notice shall be included in all copies or substantial portions"
        ' of the Software. THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A'
        " PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT,"
        " TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE.",
    ),
    (
        "ISC",
        "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the above copyright notice and this permission"
        ' notice appear in all copies. THE SOFTWARE IS PROVIDED "AS IS" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING ALL IMPLIED WARRANTIES OF MERCHANTABILITY'
        " AND FITNESS. IN NO EVENT SHALL THE AUTHOR BE LIABLE FOR ANY SPECIAL, DIRECT, INDIRECT, OR CONSEQUENTIAL DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING FROM LOSS OF USE, DATA OR PROFITS,"
        " WHETHER IN AN ACTION OF CONTRACT, NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING OUT OF OR IN CONNECTION WITH THE USE OR PERFORMANCE OF THIS SOFTWARE.",
    ),
    (
        "BSD-2-Clause",
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met: 1. Redistributions of source code must"
        " retain the above copyright notice, this list of conditions and the following disclaimer. 2. Redistributions in binary form must reproduce the above copyright notice, this list of"
        " conditions and the following disclaimer in the documentation and/or other materials provided with the distribution. " + _BSD_DISCLAIMER,
    ),
    (
        "BSD-3-Clause",
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met: 1. Redistributions of source code must"
        " retain the above copyright notice, this list of conditions and the following disclaimer. 2. Redistributions in binary form must reproduce the above copyright notice, this list of"
        " conditions and the following disclaimer in the documentation and/or other materials provided with the distribution. 3. Neither the name of the copyright holder nor the names of its"
        " contributors may be used to endorse or promote products derived from this software without specific prior written permission. " + _BSD_DISCLAIMER,
    ),
    (
        "Zlib",
        "This software is provided 'as-is', without any express or implied warranty. In no event will the authors be held liable for any damages arising from the use of this software."
        " Permission is granted to anyone to use this software for any purpose, including commercial applications, and to alter it and redistribute it freely, subject to the following"
        " restrictions: 1. The origin of this software must not be misrepresented; you must not claim that you wrote the original software. If you use this software in a product, an"
        " acknowledgment in the product documentation would be appreciated but is not required. 2. Altered source versions must be plainly marked as such, and must not be misrepresented as"
        " being the original software. 3. This notice may not be removed or altered from any source distribution.",
    ),
    (
        "LGPL-2.1-or-later",
        "This library is free software; you can redistribute it and/or modify it under the terms of the GNU Lesser General Public License as published by the Free Software Foundation; either"
        " version 2.1 of the License, or (at your option) any later version. This library is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; without even the implied"
        " warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE. See the GNU Lesser General Public License for more details.",
    ),
    (
        "GPL-2.0-or-later",
        "This program is free software; you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation; either version 2"
        " of the License, or (at your option) any later version. This program is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; without even the implied warranty of"
        " MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE. See the GNU General Public License for more details.",
    ),
    (
        "AGPL-3.0-or-later",
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU Affero General Public License as published by the Free Software Foundation, either"
        " version 3 of the License, or (at your option) any later version. This program is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; without even the implied"
        " warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE. See the GNU Affero General Public License for more details.",
    ),
    ("BSD-3-Clause", "Licensed under the BSD 3-Clause License."),
    ("BSD-2-Clause", "Licensed under the BSD 2-Clause License."),
    ("GPL-3.0", "This work is licensed under the GNU General Public License, version 3."),
    ("GPL-3.0", "Licensed under the GNU General Public License, version 3."),
    ("GPL-2.0", "This work is licensed under the GNU General Public License, version 2."),
    (
        "GPL-3.0-or-later",
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation, either version 3"
        " of the License, or (at your option) any later version. This program is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; without even the implied warranty of"
        " MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE. See the GNU General Public License for more details.",
    ),
    ("MPL-2.0", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was not distributed with this file, You can obtain one at http://mozilla.org/MPL/2.0/."),
    ("CC-BY-4.0", "Licensed under CC BY 4.0."),
    ("CC-BY-4.0", "This work is licensed under a Creative Commons Attribution 4.0 International License."),
    ("CC-BY-SA-4.0", "Licensed under CC BY-SA 4.0."),
    ("CC-BY-SA-4.0", "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License."),
    ("CC-BY-NC-4.0", "Licensed under CC BY-NC 4.0."),
    ("CC-BY-NC-4.0", "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License."),
    ("CC0-1.0", "To the extent possible under law, the author has waived all copyright and related or neighboring rights to this work."),
    ("Unlicense", "This is free and unencumbered software released into the public domain."),
)

THRESHOLD = 0.8
#: A copyright clause at the head of a line, up to the end of its sentence.
_COPYRIGHT = re.compile(r"(^|\n)[ \t]*(?:[Cc][Oo][Pp][Yy][Rr][Ii][Gg][Hh][Tt]|\([Cc]\)|©)(?:[^.!?\n]|[.!?][^ \t\r\n.!?])*[.!?]*")
_PARAGRAPH = re.compile(r"\n[ \t\r]*\n")
_SENTENCE = re.compile(r"(?:[^.!?\n]|[.!?][^ \t\r\n.!?])+[.!?]*")

MATCH = T.StructType([T.StructField("license", T.StringType()), T.StructField("dice", T.DoubleType()), T.StructField("part", T.StringType())])


def bigrams(text: str) -> Counter:
    words = normalised(text).split()
    return Counter(zip(words, words[1:]))


def parts_of(text: str) -> list[str]:
    """Sentences, lines, paragraphs and the whole text, each once."""
    clean = _COPYRIGHT.sub(r"\1", text)
    return list(dict.fromkeys([*_SENTENCE.findall(clean), *clean.split("\n"), *_PARAGRAPH.split(clean), clean]))


class Scanner:
    """Templates by size; ``best`` compares a part with those that its size leaves."""

    def __init__(self, templates: tuple[tuple[str, str], ...], threshold: float) -> None:
        made = [(sum(b.values()), name, b) for name, text in templates for b in [bigrams(text)]]
        self.templates = sorted((t for t in made if t[0]), key=lambda t: t[:2])
        self.sizes, self.threshold = [t[0] for t in self.templates], threshold
        self.low, self.high = threshold / (2 - threshold), (2 - threshold) / threshold
        self.most = int(self.sizes[-1] * self.high + 1) if self.templates else 0
        self.known = {b for _, _, own in self.templates for b in own}
        #: A match of the smallest template shares so many of its bigrams, and no match shares fewer.
        self.least = threshold * (1 + self.low) / 2 * self.sizes[0] - 1e-9 if self.templates else 0.0
        self.memo: dict[str, tuple[str, float] | None] = {}

    def best(self, part: str) -> tuple[str, float] | None:
        """The template name of the highest coefficient, the first in the alphabet of equal ones; None below the threshold."""
        if not self.templates:
            return None
        if (known := self.memo.get(part, part)) is not part:
            return known
        words = normalised(part).split()
        n = len(words) - 1
        found: tuple[float, str] | None = None
        if 0 < n <= self.most:
            own = Counter(zip(words, words[1:]))
            slack = 1e-9
            for size, name, other in self.templates[bisect_left(self.sizes, n * self.low - slack) : bisect_right(self.sizes, n * self.high + slack)]:
                shared = sum(min(c, own[b]) for b, c in other.items() if b in own)
                dice = 2 * shared / (n + size)
                if dice >= self.threshold and (found is None or (-dice, name) < (-found[0], found[1])):
                    found = dice, name
        result = (found[1], found[0]) if found else None
        if n <= self.most:
            if len(self.memo) > 50_000:
                self.memo.clear()
            self.memo[part] = result
        return result

    def may_match(self, text: str) -> bool:
        """Whether the text has enough template bigrams for any match at all."""
        words = normalised(_COPYRIGHT.sub(r"\1", text)).split()
        return sum(map(self.known.__contains__, zip(words, words[1:]))) >= self.least

    def runs(self, text: str) -> list[tuple[str, float, str]]:
        """(license, dice, run) of the best runs of two or more consecutive paragraphs, but not of the whole text.

        A run of n bigrams needs n * low bigrams of a template of its own size
        or so; runs with fewer bigrams of any template are not compared.
        """
        clean = _COPYRIGHT.sub(r"\1", text)
        spans, at = [], 0
        for m in _PARAGRAPH.finditer(clean):
            spans.append((at, m.start()))
            at = m.end()
        spans.append((at, len(clean)))
        if not self.templates or len(spans) < 3:
            return []
        split = [normalised(clean[a:b]).split() for a, b in spans]
        filled = [k for k, w in enumerate(split) if w]
        words = [w for s in split for w in s]
        hits = [0, *accumulate(b in self.known for b in zip(words, words[1:]))]
        need, ends = self.threshold * (1 + self.low) / 2 - 1e-9, list(accumulate(len(split[k]) for k in filled))
        if hits[-1] < need * self.sizes[0] * self.low:
            return []
        found = []
        for i in range(len(filled)):
            first = ends[i] - len(split[filled[i]])
            for j in range(i + 1, len(filled)):
                n = ends[j] - first - 1
                if n > self.most:
                    break
                if (i or j < len(filled) - 1) and hits[ends[j] - 1] - hits[first] >= need * n:
                    run = clean[spans[filled[i]][0] : spans[filled[j]][1]]
                    if m := self.best(run):
                        found.append((-m[1], m[0], i, j, run))
        chosen: list[tuple] = []
        for dice, name, i, j, run in sorted(found):
            if all(j < c[2] or i > c[3] for c in chosen) and not any((m := self.best(p)) and m[1] >= -dice for p in parts_of(run) if p != run):
                chosen.append((dice, name, i, j, run))
        return [(name, -dice, run) for dice, name, _, _, run in chosen]


def scan_licenses(docs: DataFrame, templates: tuple[tuple[str, str], ...] = TEMPLATES, threshold: float = THRESHOLD, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per row its id and ``matches``: array of (license, dice, part), best first.

    Each distinct part counts once.  Null and empty texts, and parts of one
    word, match nothing; repeated rows are scanned each, texts of any length
    whole.  Of templates that match equally well the first in the alphabet is
    named.  One narrow pass; the templates are constants of the call.  Other
    columns are never read, and an empty table gives an empty result.
    """
    kind = docs.schema[id_col].dataType
    from pyspark.sql.pandas.types import to_arrow_type

    match_type = to_arrow_type(T.ArrayType(MATCH))

    def scanned(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scanner = Scanner(templates, threshold)
        for group in common.text_groups(batches):
            rows = []
            for text in group.column("text").to_pylist():
                if not text or not scanner.may_match(text):
                    rows.append([])
                    continue
                found = [(m[0], m[1], p) for p in parts_of(text or "") if (m := scanner.best(p))]
                seen = {p for _, _, p in found}
                found += [m for m in scanner.runs(text or "") if m[2] not in seen]
                found.sort(key=lambda m: (-m[1], m[0], m[2]))
                rows.append([{"license": a, "dice": b, "part": c} for a, b, c in found])
            yield pa.RecordBatch.from_arrays([group.column("id"), pa.array(rows, match_type)], names=[id_col, "matches"])

    rows = docs.selectExpr(f"`{id_col}` AS id", f"`{text_col}` AS text")
    return rows.mapInArrow(scanned, T.StructType([T.StructField(id_col, kind), T.StructField("matches", T.ArrayType(MATCH))]))
