"""License scans: patience alignment of texts with license templates, for coverage.

Words that are unique to both text and template are anchors; the longest increasing subsequence of them is kept, and the gaps
between kept anchors are aligned in the same way. A gap without such words is anchored on runs of two, then of four words that are unique to
both; without those too, its equal first and last words still match. Coverage is the share of the template's words that are
matched.

A text that has fewer than min_coverage of a template's words, anywhere and counted, can't reach min_coverage. Else a template of LONG words or more is aligned
with the whole text, so its parts may stand any distance apart. If that falls short, because the text has the license several times,
and for shorter templates, which are phrases, stretches of SLACK template lengths are aligned; so of a text with several copies that all have
text put in between, none may be found.

A document's licenses are the templates that reach min_coverage, less those most of whose matched words a better one has matched as
well; the best one has the most matched words less words that are not, so of relatives the one that explains the text wins.
Texts are mapped in Arrow batches without a shuffle; work and memory follow a text's length.

Defined results. Null, empty or wordless text: no license. Repeated rows give a row each. Of templates that match equally,
the first by name is the better. Extra columns are not read.
"""

from __future__ import annotations

import re
from bisect import bisect_left
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

WORD = re.compile(r"[^\W_]+(?:[.'-][^\W_]+)*")
MIN_COVERAGE = 0.8
SLACK = 1.5

#: Lengths of the runs that gaps are anchored on.
RUNS = (1, 2, 4)
#: Words from which a template may be spread over the whole text.
LONG = 20

# Phrases, notices and license texts that the scan looks for.
TEMPLATES: dict[str, str] = {
    "0BSD": """Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted. THE SOFTWARE IS
PROVIDED "AS IS" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING ALL IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS.
IN NO EVENT SHALL THE AUTHOR BE LIABLE FOR ANY SPECIAL, DIRECT, INDIRECT, OR CONSEQUENTIAL DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING FROM LOSS OF
USE, DATA OR PROFITS, WHETHER IN AN ACTION OF CONTRACT, NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING OUT OF OR IN CONNECTION WITH THE USE OR
PERFORMANCE OF THIS SOFTWARE.""",
    "AGPL-3.0 notice": """This program is free software: you can redistribute it and/or modify it under the terms of the GNU Affero General Public
License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version. This program is
distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; without even the implied warranty of MERCHANTABILITY or FITNESS FOR A
PARTICULAR PURPOSE. See the GNU Affero General Public License for more details. You should have received a copy of the GNU Affero General Public
License along with this program. If not, see https://www.gnu.org/licenses/.""",
    "Apache-2.0": "Licensed under the Apache License, Version 2.0.",
    "Apache-2.0 notice": """Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in compliance with the
License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0 Unless required by applicable law or agreed to in
writing, software distributed under the License is distributed on an "AS IS" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express
or implied. See the License for the specific language governing permissions and limitations under the License.""",
    "BSD-2-Clause": """Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following
conditions are met: 1. Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer.
2. Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer in the
documentation and/or other materials provided with the distribution. THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS "AS IS" AND
ANY EXPRESS OR IMPLIED WARRANTIES, INCLUDING, BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE
DISCLAIMED. IN NO EVENT SHALL THE COPYRIGHT HOLDER OR CONTRIBUTORS BE LIABLE FOR ANY DIRECT, INDIRECT, INCIDENTAL, SPECIAL, EXEMPLARY, OR
CONSEQUENTIAL DAMAGES (INCLUDING, BUT NOT LIMITED TO, PROCUREMENT OF SUBSTITUTE GOODS OR SERVICES; LOSS OF USE, DATA, OR PROFITS; OR BUSINESS
INTERRUPTION) HOWEVER CAUSED AND ON ANY THEORY OF LIABILITY, WHETHER IN CONTRACT, STRICT LIABILITY, OR TORT (INCLUDING NEGLIGENCE OR OTHERWISE)
ARISING IN ANY WAY OUT OF THE USE OF THIS SOFTWARE, EVEN IF ADVISED OF THE POSSIBILITY OF SUCH DAMAGE.""",
    "BSD-3-Clause": """Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following
conditions are met: 1. Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer.
2. Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer in the
documentation and/or other materials provided with the distribution. 3. Neither the name of the copyright holder nor the names of its contributors
may be used to endorse or promote products derived from this software without specific prior written permission. THIS SOFTWARE IS PROVIDED BY THE
COPYRIGHT HOLDERS AND CONTRIBUTORS "AS IS" AND ANY EXPRESS OR IMPLIED WARRANTIES, INCLUDING, BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF
MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE DISCLAIMED. IN NO EVENT SHALL THE COPYRIGHT HOLDER OR CONTRIBUTORS BE LIABLE FOR ANY DIRECT,
INDIRECT, INCIDENTAL, SPECIAL, EXEMPLARY, OR CONSEQUENTIAL DAMAGES (INCLUDING, BUT NOT LIMITED TO, PROCUREMENT OF SUBSTITUTE GOODS OR SERVICES; LOSS
OF USE, DATA, OR PROFITS; OR BUSINESS INTERRUPTION) HOWEVER CAUSED AND ON ANY THEORY OF LIABILITY, WHETHER IN CONTRACT, STRICT LIABILITY, OR TORT
(INCLUDING NEGLIGENCE OR OTHERWISE) ARISING IN ANY WAY OUT OF THE USE OF THIS SOFTWARE, EVEN IF ADVISED OF THE POSSIBILITY OF SUCH DAMAGE.""",
    "BSD-4-Clause": """Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following
conditions are met: 1. Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer.
2. Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer in the
documentation and/or other materials provided with the distribution. 3. All advertising materials mentioning features or use of this software must
display the following acknowledgement: This product includes software developed by the organization. 4. Neither the name of the copyright holder nor
the names of its contributors may be used to endorse or promote products derived from this software without specific prior written permission. THIS
SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS "AS IS" AND ANY EXPRESS OR IMPLIED WARRANTIES, INCLUDING, BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF
MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE DISCLAIMED. IN NO EVENT SHALL THE COPYRIGHT HOLDER BE LIABLE FOR ANY DIRECT, INDIRECT,
INCIDENTAL, SPECIAL, EXEMPLARY, OR CONSEQUENTIAL DAMAGES (INCLUDING, BUT NOT LIMITED TO, PROCUREMENT OF SUBSTITUTE GOODS OR SERVICES; LOSS OF USE,
DATA, OR PROFITS; OR BUSINESS INTERRUPTION) HOWEVER CAUSED AND ON ANY THEORY OF LIABILITY, WHETHER IN CONTRACT, STRICT LIABILITY, OR TORT (INCLUDING
NEGLIGENCE OR OTHERWISE) ARISING IN ANY WAY OUT OF THE USE OF THIS SOFTWARE, EVEN IF ADVISED OF THE POSSIBILITY OF SUCH DAMAGE.""",
    "BSL-1.0": """Permission is hereby granted, free of charge, to any person or organization obtaining a copy of the software and accompanying
documentation covered by this license (the "Software") to use, reproduce, display, distribute, execute, and transmit the Software, and to prepare
derivative works of the Software, and to permit third-parties to whom the Software is furnished to do so, all subject to the following: The copyright
notices in the Software and this entire statement, including the above license grant, this restriction and the following disclaimer, must be included
in all copies of the Software, in whole or in part, and all derivative works of the Software, unless such copies or derivative works are solely in the
form of machine-executable object code generated by a source language processor. THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS
OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE, TITLE AND NON-INFRINGEMENT. IN NO EVENT
SHALL THE COPYRIGHT HOLDERS OR ANYONE DISTRIBUTING THE SOFTWARE BE LIABLE FOR ANY DAMAGES OR OTHER LIABILITY, WHETHER IN CONTRACT, TORT OR OTHERWISE,
ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE.""",
    "CC-BY-4.0": "This work is licensed under a Creative Commons Attribution 4.0 International License.",
    "CC-BY-NC-4.0": "Licensed under CC BY-NC 4.0.",
    "CC-BY-SA-4.0": "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License.",
    "GPL-2.0": "This work is licensed under the GNU General Public License, version 2.",
    "GPL-2.0 notice": """This program is free software; you can redistribute it and/or modify it under the terms of the GNU General Public License as
published by the Free Software Foundation; either version 2 of the License, or (at your option) any later version. This program is distributed in the
hope that it will be useful, but WITHOUT ANY WARRANTY; without even the implied warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE. See
the GNU General Public License for more details.""",
    "GPL-3.0": "This work is licensed under the GNU General Public License, version 3.",
    "GPL-3.0 notice": """This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as
published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version. This program is distributed in
the hope that it will be useful, but WITHOUT ANY WARRANTY; without even the implied warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE.
See the GNU General Public License for more details.""",
    "ISC": """Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the
above copyright notice and this permission notice appear in all copies. THE SOFTWARE IS PROVIDED "AS IS" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH
REGARD TO THIS SOFTWARE INCLUDING ALL IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL THE AUTHOR BE LIABLE FOR ANY SPECIAL,
DIRECT, INDIRECT, OR CONSEQUENTIAL DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING FROM LOSS OF USE, DATA OR PROFITS, WHETHER IN AN ACTION OF CONTRACT,
NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING OUT OF OR IN CONNECTION WITH THE USE OR PERFORMANCE OF THIS SOFTWARE.""",
    "LGPL-2.1 notice": """This library is free software; you can redistribute it and/or modify it under the terms of the GNU Lesser General Public License
as published by the Free Software Foundation; either version 2.1 of the License, or (at your option) any later version. This library is distributed in
the hope that it will be useful, but WITHOUT ANY WARRANTY; without even the implied warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE.
See the GNU Lesser General Public License for more details.""",
    "LGPL-3.0 notice": """This program is free software: you can redistribute it and/or modify it under the terms of the GNU Lesser General Public License
as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version. This program is distributed in
the hope that it will be useful, but WITHOUT ANY WARRANTY; without even the implied warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE.
See the GNU Lesser General Public License for more details.""",
    "MIT": "Released under the MIT License.",
    "MIT text": """Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the
"Software"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute,
sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the following
conditions: The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software. THE
SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS
FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY,
WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE
SOFTWARE.""",
    "MPL-2.0 notice": """This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was not distributed with
this file, You can obtain one at https://mozilla.org/MPL/2.0/.""",
    "Reserved": "All rights reserved.",
    "Unlicense": """This is free and unencumbered software released into the public domain. Anyone is free to copy, modify, publish, use, compile, sell, or
distribute this software, either in source code form or as a compiled binary, for any purpose, commercial or non-commercial, and by any means. In
jurisdictions that recognize copyright laws, the author or authors of this software dedicate any and all copyright interest in the software to the
public domain. We make this dedication for the benefit of the public at large and to the detriment of our heirs and successors. We intend this
dedication to be an overt act of relinquishment in perpetuity of all present and future rights to this software under copyright law. THE SOFTWARE IS
PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A
PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF
CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE.""",
    "Zlib": """This software is provided 'as-is', without any express or implied warranty. In no event will the authors be held liable for any damages
arising from the use of this software. Permission is granted to anyone to use this software for any purpose, including commercial applications, and to
alter it and redistribute it freely, subject to the following restrictions: 1. The origin of this software must not be misrepresented; you must not
claim that you wrote the original software. If you use this software in a product, an acknowledgment in the product documentation would be appreciated
but is not required. 2. Altered source versions must be plainly marked as such, and must not be misrepresented as being the original software. 3. This
notice may not be removed or altered from any source distribution.""",
}


def words_of(text: str) -> list[str]:
    return WORD.findall(text.lower())


def increasing(pairs: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """The longest subsequence of pairs, sorted by the first number, whose second numbers rise (patience sorting)."""
    tops: list[int] = []
    last: list[int] = []
    back: list[int] = []
    for k, (_, b) in enumerate(pairs):
        pile = bisect_left(tops, b)
        back.append(last[pile - 1] if pile else -1)
        if pile == len(tops):
            tops.append(b), last.append(k)
        else:
            tops[pile], last[pile] = b, k
    out, k = [], last[-1] if last else -1
    while k >= 0:
        out.append(pairs[k])
        k = back[k]
    return out[::-1]


def _anchors(text: list[str], a0: int, a1: int, template: list[str], b0: int, b1: int, n: int) -> list[tuple[int, int]]:
    """Places of runs of n words that are unique to both stretches, rising in both."""

    def once(words: list[str], lo: int, hi: int) -> dict[tuple[str, ...], int]:
        runs = list(zip(*(words[lo + k : hi - n + 1 + k] for k in range(n)), strict=False))
        count = Counter(runs)
        return {r: lo + k for k, r in enumerate(runs) if count[r] == 1}

    where, there = once(text, a0, a1), once(template, b0, b1)
    return increasing(sorted((where[r], at) for r, at in there.items() if r in where))


def align(text: list[str], template: list[str]) -> list[tuple[int, int]]:
    """Matched positions (in text, in template), rising in both."""
    out: list[tuple[int, int]] = []
    todo = [(0, len(text), 0, len(template))]
    while todo:
        a0, a1, b0, b1 = todo.pop()
        while a0 < a1 and b0 < b1 and text[a0] == template[b0]:
            out.append((a0, b0))
            a0, b0 = a0 + 1, b0 + 1
        while a0 < a1 and b0 < b1 and text[a1 - 1] == template[b1 - 1]:
            a1, b1 = a1 - 1, b1 - 1
            out.append((a1, b1))
        if a0 == a1 or b0 == b1:
            continue
        anchors = next(filter(None, (_anchors(text, a0, a1, template, b0, b1, n) for n in RUNS)), None)
        if not anchors:
            continue
        out += anchors
        edges = [(a0 - 1, b0 - 1), *anchors, (a1, b1)]
        todo += [(x[0] + 1, y[0], x[1] + 1, y[1]) for x, y in zip(edges, edges[1:], strict=False)]
    return sorted(out)


@dataclass(frozen=True)
class Match:
    name: str
    size: int
    pairs: list[tuple[int, int]]

    @property
    def coverage(self) -> float:
        return len(self.pairs) / self.size


class Scanner:
    def __init__(self, templates: dict[str, str], min_coverage: float = MIN_COVERAGE):
        self.templates = [(name, words_of(t)) for name, t in sorted(templates.items())]
        self.min_coverage = min_coverage
        self.codes = {w: k for k, w in enumerate(sorted({w for _, t in self.templates for w in t}))}
        self.count = np.zeros((len(self.templates), len(self.codes) + 1), dtype=np.int64)
        for row, (_, t) in enumerate(self.templates):
            np.add.at(self.count[row], [self.codes[w] for w in t], 1)
        self.member = (self.count > 0).astype(np.int32)
        self.need = np.array([int(np.ceil(min_coverage * len(t))) for _, t in self.templates], dtype=np.int64)

    def stretches(self, codes: np.ndarray, row: int) -> list[tuple[int, int]]:
        """Where template number row can lie, as word ranges that don't overlap."""
        need, width = self.need[row], int(np.ceil(SLACK * len(self.templates[row][1])))
        total = np.concatenate(([0], np.cumsum(self.member[row][codes])))
        if total[-1] < need:
            return []
        ends = np.minimum(np.arange(len(codes)) + width, len(codes))
        starts = np.flatnonzero(total[ends] - total[:-1] >= need)
        out: list[tuple[int, int]] = []
        for s in starts.tolist():
            e = int(ends[s])
            if out and s < out[-1][1]:
                out[-1] = (out[-1][0], e)
            else:
                out.append((s, e))
        return out

    def best(self, words: list[str], codes: np.ndarray, row: int) -> list[tuple[int, int]]:
        """The most matched pairs of positions that template number row has, in the whole text or in a stretch."""
        template = self.templates[row][1]
        best: list[tuple[int, int]] = []
        if len(template) >= LONG:
            # What stands before the first word of the template, or behind the last, can't match.
            own = np.flatnonzero(self.member[row][codes])
            lo = int(own[0])
            best = [(a + lo, b) for a, b in align(words[lo : int(own[-1]) + 1], template)]
            if len(best) >= self.need[row]:
                return best
        width = int(np.ceil(SLACK * len(template)))
        step = max(1, width // 4)
        for a, b in self.stretches(codes, row):
            # A long stretch holds several windows; each is aligned by itself.
            for at in range(a, max(a + 1, b - width + step), step):
                pairs = align(words[at : min(b, at + width + step)], template)
                if len(pairs) > len(best):
                    best = [(x + at, y) for x, y in pairs]
        return best

    def scan(self, text: str) -> list[Match]:
        """The document's licenses, the best one first."""
        words = words_of(text)
        codes = np.fromiter((self.codes.get(w, len(self.codes)) for w in words), dtype=np.int64, count=len(words))
        had = np.minimum(np.bincount(codes, minlength=len(self.codes) + 1), self.count).sum(axis=1)
        found = [Match(self.templates[row][0], len(self.templates[row][1]), self.best(words, codes, row)) for row in np.flatnonzero(had >= self.need).tolist()]
        found = [m for m in found if len(m.pairs) >= self.min_coverage * m.size]
        found.sort(key=lambda m: (m.size - 2 * len(m.pairs), m.name))
        out, used = [], set()
        for m in found:
            at = {a for a, _ in m.pairs}
            if 2 * len(at & used) <= len(at):
                out.append(m)
                used |= at
        return out


def license_scan(docs: DataFrame, templates: dict[str, str] = TEMPLATES, min_coverage: float = MIN_COVERAGE) -> DataFrame:
    """doc_id; license, coverage, n_matched, first_word, last_word of the best template (null if none); licenses: the names of all
    the document's licenses, sorted."""
    names = ["doc_id", "license", "coverage", "n_matched", "first_word", "last_word", "licenses"]
    kinds = [pa.int64(), pa.string(), pa.float64(), pa.int64(), pa.int64(), pa.int64(), pa.list_(pa.string())]

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scanner = Scanner(templates, min_coverage)
        for batch in batches:
            rows = []
            for doc_id, text in zip(batch["doc_id"].to_pylist(), batch["text"], strict=True):
                found = scanner.scan(text.as_py() or "")
                m = found[0] if found else None
                best = (m.name, m.coverage, len(m.pairs), m.pairs[0][0], m.pairs[-1][0]) if m else (None,) * 5
                rows.append((doc_id, *best, sorted(x.name for x in found)))
            columns = list(zip(*rows, strict=True)) or [[]] * len(names)
            yield pa.record_batch([pa.array(c, t) for c, t in zip(columns, kinds, strict=True)], names)

    return docs.select("doc_id", "text").mapInArrow(
        scan, "doc_id long, license string, coverage double, n_matched long, first_word long, last_word long, licenses array<string>"
    )
