"""License notices in texts: MinHash bands over overlapping windows, verified by shingle containment.

Templates are license notices. Words are lower-cased ASCII letters and digits;
shingles are runs of five words. For a template of k shingles, a text's
windows hold 1.25 k shingles and start every k / 4. Windows and template are
reduced to MinHash values; a window that agrees with the template in one band
is a candidate, and one that holds at least 80 % of the template's shingles is
a match. Band settings are checked against the worst window that still
matches: it must be missed with a probability of at most ``MISS``. Values are
computed only for windows that hold a shingle of some template; the others
can't agree in a band.

Overlapping matches of one template are one stretch of text, which is cut into
copies from left to right: a copy is a run of at most a window's shingles that
holds enough of the template, and it ends where the template's order starts
again and another copy follows. Of its runs the one with the highest
containment counts, the shortest of equals. Copies do not overlap. A find
inside another is dropped if that has a higher containment, or the same and a
longer template.

Templates are bodies and notices of public licenses, and one-line notices made
by rule; a line below five words holds no shingle and is not found. They are a
table of fixed size, built once by each worker.

Defined results: null and empty texts, and texts below five words, have no
finds; repeated rows are scanned alike; other columns are ignored; an empty
table gives an empty result.
"""

from __future__ import annotations

import bisect
import math
import re
from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quarry.llm.common import PerWorker, map_arrow, odd_multipliers, slices
from quarry.llm.shingles import WordHashes, shingle_hashes

# fixed values: wording of public license notices
TEMPLATES = {
    "Apache-2.0 line": "Licensed under the Apache License, Version 2.0.",
    "Apache-2.0 notice": """Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file
        except in compliance with the License. You may obtain a copy of the License at
        http://www.apache.org/licenses/LICENSE-2.0. Unless required by applicable law or agreed to in writing,
        software distributed under the License is distributed on an "AS IS" BASIS, WITHOUT WARRANTIES OR CONDITIONS
        OF ANY KIND, either express or implied. See the License for the specific language governing permissions and
        limitations under the License.""",
    "MIT line": "Released under the MIT License.",
    "MIT permission": """Permission is hereby granted, free of charge, to any person obtaining a copy of this software
        and associated documentation files (the "Software"), to deal in the Software without restriction, including
        without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies
        of the Software, and to permit persons to whom the Software is furnished to do so, subject to the following
        conditions: The above copyright notice and this permission notice shall be included in all copies or
        substantial portions of the Software.""",
    "BSD conditions": """Redistribution and use in source and binary forms, with or without modification, are permitted
        provided that the following conditions are met: Redistributions of source code must retain the above copyright
        notice, this list of conditions and the following disclaimer.""",
    "ISC permission": """Permission to use, copy, modify, and/or distribute this software for any purpose with or without
        fee is hereby granted, provided that the above copyright notice and this permission notice appear in all
        copies.""",
    "GPL-3.0 line": "This work is licensed under the GNU General Public License, version 3.",
    "GPL notice": """This program is free software: you can redistribute it and/or modify it under the terms of the GNU
        General Public License as published by the Free Software Foundation, either version 3 of the License, or (at
        your option) any later version.""",
    "LGPL notice": """This library is free software; you can redistribute it and/or modify it under the terms of the GNU
        Lesser General Public License as published by the Free Software Foundation.""",
    "MPL-2.0 notice": """This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of
        the MPL was not distributed with this file, You can obtain one at http://mozilla.org/MPL/2.0/.""",
    "CC-BY-4.0 line": "This work is licensed under a Creative Commons Attribution 4.0 International License.",
    "CC-BY-NC-4.0 line": "Licensed under CC BY-NC 4.0.",
    "CC0 line": "To the extent possible under law, the author has waived all copyright and related rights to this work.",
    "Unlicense": "This is free and unencumbered software released into the public domain.",
    "MIT warranty": """THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT
        LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT
        SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF
        CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS
        IN THE SOFTWARE.""",
    "BSD-2-Clause body": """Redistribution and use in source and binary forms, with or without modification, are permitted
        provided that the following conditions are met: 1. Redistributions of source code must retain the above copyright
        notice, this list of conditions and the following disclaimer. 2. Redistributions in binary form must reproduce the
        above copyright notice, this list of conditions and the following disclaimer in the documentation and/or other
        materials provided with the distribution.""",
    "BSD-3-Clause endorsement": """Neither the name of the copyright holder nor the names of its contributors may be used to
        endorse or promote products derived from this software without specific prior written permission.""",
    "BSD warranty": """THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS "AS IS" AND ANY EXPRESS OR IMPLIED
        WARRANTIES, INCLUDING, BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR
        PURPOSE ARE DISCLAIMED. IN NO EVENT SHALL THE COPYRIGHT HOLDER OR CONTRIBUTORS BE LIABLE FOR ANY DIRECT, INDIRECT,
        INCIDENTAL, SPECIAL, EXEMPLARY, OR CONSEQUENTIAL DAMAGES (INCLUDING, BUT NOT LIMITED TO, PROCUREMENT OF SUBSTITUTE
        GOODS OR SERVICES; LOSS OF USE, DATA, OR PROFITS; OR BUSINESS INTERRUPTION) HOWEVER CAUSED AND ON ANY THEORY OF
        LIABILITY, WHETHER IN CONTRACT, STRICT LIABILITY, OR TORT (INCLUDING NEGLIGENCE OR OTHERWISE) ARISING IN ANY WAY
        OUT OF THE USE OF THIS SOFTWARE, EVEN IF ADVISED OF THE POSSIBILITY OF SUCH DAMAGE.""",
    "ISC warranty": """THE SOFTWARE IS PROVIDED "AS IS" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE
        INCLUDING ALL IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL THE AUTHOR BE LIABLE FOR ANY
        SPECIAL, DIRECT, INDIRECT, OR CONSEQUENTIAL DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING FROM LOSS OF USE, DATA OR
        PROFITS, WHETHER IN AN ACTION OF CONTRACT, NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING OUT OF OR IN CONNECTION
        WITH THE USE OR PERFORMANCE OF THIS SOFTWARE.""",
    "Zlib body": """This software is provided 'as-is', without any express or implied warranty. In no event will the authors be
        held liable for any damages arising from the use of this software. Permission is granted to anyone to use this
        software for any purpose, including commercial applications, and to alter it and redistribute it freely, subject to
        the following restrictions: 1. The origin of this software must not be misrepresented; you must not claim that you
        wrote the original software. If you use this software in a product, an acknowledgment in the product documentation
        would be appreciated but is not required. 2. Altered source versions must be plainly marked as such, and must not be
        misrepresented as being the original software. 3. This notice may not be removed or altered from any source
        distribution.""",
    "GPL-2.0 notice": """This program is free software; you can redistribute it and/or modify it under the terms of the GNU
        General Public License as published by the Free Software Foundation; either version 2 of the License, or (at your
        option) any later version.""",
    "GPL warranty": """This program is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; without even
        the implied warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE. See the GNU General Public License for
        more details.""",
    "AGPL-3.0 notice": """This program is free software: you can redistribute it and/or modify it under the terms of the GNU
        Affero General Public License as published by the Free Software Foundation, either version 3 of the License, or (at
        your option) any later version.""",
    "EPL-2.0 notice": """This program and the accompanying materials are made available under the terms of the Eclipse Public
        License 2.0 which is available at https://www.eclipse.org/legal/epl-2.0/""",
    "BSL-1.0 line": "Distributed under the Boost Software License, Version 1.0.",
}

# fixed values: names of public licenses as lines use them, and the words before them
LICENSE_NAMES = {
    "MIT": ["MIT License"],
    "Apache-2.0": ["Apache License, Version 2.0", "Apache License 2.0", "Apache 2.0 License"],
    "BSD-2-Clause": ["BSD 2-Clause License", "2-clause BSD license"],
    "BSD-3-Clause": ["BSD 3-Clause License", "3-clause BSD license"],
    "GPL-2.0": ["GNU General Public License, version 2", "GNU GPL version 2", "GPLv2 license"],
    "GPL-3.0": ["GNU General Public License, version 3", "GNU GPL version 3", "GPLv3 license"],
    "LGPL": ["GNU Lesser General Public License"],
    "AGPL-3.0": ["GNU Affero General Public License"],
    "MPL-2.0": ["Mozilla Public License 2.0", "Mozilla Public License, v. 2.0"],
    "EPL-2.0": ["Eclipse Public License 2.0"],
    "ISC": ["ISC License"],
    "BSL-1.0": ["Boost Software License, Version 1.0"],
}
LICENSED = ["licensed under the", "released under the", "distributed under the", "available under the", "provided under the"]
CC_KINDS = {"BY": "Attribution", "BY-SA": "Attribution-ShareAlike", "BY-NC": "Attribution-NonCommercial",
            "BY-NC-SA": "Attribution-NonCommercial-ShareAlike", "BY-ND": "Attribution-NoDerivatives",
            "BY-NC-ND": "Attribution-NonCommercial-NoDerivatives"}
SPDX = ["Apache-2.0", "BSD-2-Clause", "BSD-3-Clause", "GPL-2.0-only", "GPL-2.0-or-later", "GPL-3.0-only", "GPL-3.0-or-later",
        "LGPL-2.1-only", "LGPL-2.1-or-later", "AGPL-3.0-only", "AGPL-3.0-or-later", "MPL-2.0", "EPL-2.0", "BSL-1.0", "CC0-1.0",
        "CC-BY-4.0"]


def line_templates() -> dict[str, str]:
    """One-line notices by rule: every license name after every way to say that it applies, Creative Commons kinds in two
    versions, and identifier lines that are long enough for a shingle."""
    lines = {f"{short} line: {words} {name}": f"{words} {name}"
             for short, names in LICENSE_NAMES.items() for name in names for words in LICENSED}
    for kind, name in CC_KINDS.items():
        for version in ("3.0", "4.0"):
            lines[f"CC-{kind}-{version} line"] = f"licensed under CC {kind} {version}"
            lines[f"CC-{kind}-{version} name"] = f"CC {kind} {version}"
            lines[f"CC-{kind}-{version} sentence"] = \
                f"licensed under a Creative Commons {name} {version} {'International' if version == '4.0' else 'Unported'} License"
    return lines | {f"{name} identifier": f"SPDX-License-Identifier: {name}" for name in SPDX}


def all_templates() -> dict[str, str]:
    """The notices above, and the lines that are none of them word for word."""
    words = lambda text: tuple(WORD.findall(text.encode().lower()))
    out, seen = dict(TEMPLATES), {words(t) for t in TEMPLATES.values()}
    for name, text in line_templates().items():
        if words(text) not in seen and len(words(text)) >= SHINGLE:
            seen.add(words(text))
            out[name.replace(",", "")] = text
    return out

SHINGLE = 5
CONTAINMENT = 0.8
STRETCH = 1.25            # shingles of a window, times those of the template
STRIDES = 4               # window starts per template length
BANDS, ROWS = 64, 2
MISS = 1e-6
WORD = re.compile(rb"[a-z0-9]+")


def word_hashes(text: str | None, hashes: WordHashes) -> np.ndarray:
    words = WORD.findall((text or "").encode("utf-8", "surrogatepass").lower())
    return np.fromiter(map(hashes.__getitem__, words), np.uint64, len(words))


def shingles(text: str | None, hashes: WordHashes) -> np.ndarray:
    """Shingle hashes in text order; none below SHINGLE words."""
    words = word_hashes(text, hashes)
    return shingle_hashes(words, SHINGLE) if len(words) >= SHINGLE else np.zeros(0, np.uint64)


def signature(values: np.ndarray) -> np.ndarray:
    """Band keys of a set of shingles."""
    low = (values[None, :] * odd_multipliers(BANDS * ROWS, 71)[:, None]).min(axis=1).reshape(BANDS, ROWS)
    return (low * odd_multipliers(ROWS, 73)).sum(axis=1)


class Template:
    def __init__(self, name: str, text: str, hashes: WordHashes):
        self.name = name
        wording = shingles(text, hashes)
        self.shingles = np.unique(wording)
        self.places: dict[int, list[int]] = {}           # of each shingle in the template
        for i, v in enumerate(wording.tolist()):
            self.places.setdefault(v, []).append(i)
        self.size = len(self.shingles)
        if not self.size:
            raise ValueError(f"template {name!r} has fewer than {SHINGLE} words")
        self.needed = math.ceil(CONTAINMENT * self.size)
        self.stride = max(1, self.size // STRIDES)
        self.window = math.ceil(STRETCH * self.size)
        self.bands = signature(self.shingles)
        # a matching window has `needed` shingles in common out of all of both
        least = self.needed / (self.window + self.size - self.needed)
        if (1 - least ** ROWS) ** BANDS > MISS:
            raise ValueError(f"bands are too strict for template {name!r}")


class Matcher:
    """Finds templates in texts."""

    def __init__(self, templates: dict[str, str]):
        self.hashes = WordHashes()
        self.templates = [Template(n, t, self.hashes) for n, t in templates.items()]
        self.known = np.unique(np.concatenate([t.shingles for t in self.templates]))
        self.owners: dict[int, list[int]] = {}           # templates of each shingle
        for k, t in enumerate(self.templates):
            for v in t.shingles.tolist():
                self.owners.setdefault(v, []).append(k)

    def _windows(self, values: np.ndarray, hot: np.ndarray, t: Template) -> list[tuple[int, int]]:
        """(start, end) of matching windows."""
        starts = set()
        for h in hot.tolist():
            low = max(0, h - t.window + 1)
            starts.update(range(-(-low // t.stride) * t.stride, h + 1, t.stride))
        found = []
        for s in sorted(starts):
            part = values[s:s + t.window]
            if (signature(part) == t.bands).any() and len(np.intersect1d(part, t.shingles)) >= t.needed:
                found.append((s, s + len(part)))
        return found

    @staticmethod
    def _copies(at: list[int], held: list[int], t: Template) -> list[tuple[int, int, int]]:
        """(first place, last place, distinct shingles) of copies, from the places of a template's shingles."""
        found = []
        todo = [(0, len(at))]
        while todo:
            begin, end = todo.pop()
            count: Counter = Counter()
            best, low, last, stop = None, begin, -1, end
            for high in range(begin, end):
                v = held[high]
                after = t.places[v]
                k = bisect.bisect_right(after, last)
                if k == len(after):              # the template's order starts again
                    k = 0
                    if best is not None:
                        z = bisect.bisect_left(at, at[high] + t.window, high, end)
                        if len(set(held[high:z])) >= t.needed:
                            stop = high
                            break
                last = after[k]
                count[v] += 1
                while at[high] - at[low] >= t.window or count[held[low]] > 1:
                    count[held[low]] -= 1
                    if not count[held[low]]:
                        del count[held[low]]
                    low += 1
                if len(count) >= t.needed:
                    rank = len(count), at[low] - at[high]
                    if best is None or rank > best[0]:
                        best = rank, low, high
                elif best is not None:
                    stop = high
                    break
            if best is None:
                continue
            (distinct, _), low, high = best
            # matching words beside it that the template repeats
            count = Counter(held[low:high + 1])
            while high + 1 < stop and count[held[high + 1]] < len(t.places[held[high + 1]]):
                high += 1
                count[held[high]] += 1
            while low > begin and count[held[low - 1]] < len(t.places[held[low - 1]]):
                low -= 1
                count[held[low]] += 1
            found.append((at[low], at[high], distinct))
            # a word belongs to one copy
            todo.append((bisect.bisect_left(at, at[high] + SHINGLE, high, end), end))
            todo.append((begin, bisect.bisect_right(at, at[low] - SHINGLE, begin, low)))
        return sorted(found)

    def __call__(self, text: str | None) -> list[tuple[int, int, str, float]]:
        """(first word, end word, template, containment) of each find, in order."""
        values = shingles(text, self.hashes)
        at = np.searchsorted(self.known, values)
        hot = np.flatnonzero(self.known[np.minimum(at, len(self.known) - 1)] == values)
        if not len(hot):
            return []
        finds = []
        for k in sorted({k for v in set(values[hot].tolist()) for k in self.owners[v]}):
            t = self.templates[k]
            own = hot[np.isin(values[hot], t.shingles)]
            stretches: list[list[int]] = []
            for a, z in self._windows(values, own, t):
                if stretches and a < stretches[-1][1]:
                    stretches[-1][1] = z
                else:
                    stretches.append([a, z])
            finds.append([])
            for a, z in stretches:
                inside = own[np.searchsorted(own, a):np.searchsorted(own, z)]
                finds[-1] += [(first, last + SHINGLE, t.name, distinct / t.size, t.size)
                              for first, last, distinct in self._copies(inside.tolist(), values[inside].tolist(), t)]

        def inside_longer(f: tuple) -> bool:
            for others in finds:
                k = bisect.bisect_right(others, f[0], key=lambda g: g[0]) - 1
                if k >= 0 and f[1] <= others[k][1] and (others[k][3] > f[3] or others[k][4] > f[4] and others[k][3] == f[3]):
                    return True
            return False

        kept = [f for found in finds for f in found if not inside_longer(f)]
        return sorted(f[:4] for f in kept)


def scan(docs: DataFrame, templates: dict[str, str] | None = None) -> DataFrame:
    """op10: (doc_id, n_finds, licenses, spans) of every document; spans are template:first word:end word:containment."""
    shared = PerWorker(docs.sparkSession, Matcher, templates or all_templates())

    def run(batches):
        matcher = shared.get()
        for b in slices(batches):
            finds = [matcher(t) for t in b.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([
                b.column(0), pa.array([len(f) for f in finds], pa.int64()),
                pa.array([",".join(sorted({x[2] for x in f})) for f in finds], pa.string()),
                pa.array([",".join(f"{n}:{a}:{z}:{c:.3f}" for a, z, n, c in f) for f in finds], pa.string()),
            ], names=["doc_id", "n_finds", "licenses", "spans"])

    kind = docs.schema["doc_id"].dataType.simpleString()
    return map_arrow(docs.select("doc_id", F.col("text").cast("string")), run,
                     f"doc_id {kind}, n_finds bigint, licenses string, spans string")
