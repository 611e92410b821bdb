"""License scans: MinHash bands over overlapping windows retrieve templates, exact shingle containment verifies them.

A text's word shingles are cut into blocks, and windows of a few blocks overlap by all but one. A template is scanned with
blocks of about a third of its length, so each copy lies whole in one window that is not much longer. Each window's
MinHash values come from block minima, and each value is a band of its own: a window that shares the least share of
shingles a copy can have collides in at least one of the bands with the probability asked for. A retrieved template is
then looked for word by word in that text: a stretch no longer than the template and its allowance for insertions (a block
or two, as the windows have) that holds at least ``CONTAINED`` of its distinct shingles is a match. Rows stay where they are.
"""

from __future__ import annotations

import bisect
import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from lossledger.llm.columns import plain_words, slices
from lossledger.llm.hashing import Spans
from lossledger.sources.tables import materialise

SHINGLE = 5
CONTAINED = 0.8
COLLIDE = 0.9999
#: Characters of the templates that are shared with every task at a time; more of them are scanned for block by block.
MOST_CHARS = 16_000_000

#: Notices in common use, as their licenses give them.
TEMPLATES = (
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0."),
    ("Apache-2.0", 'Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in compliance with the License. You may obtain a copy of the License at'),
    ("Apache-2.0", 'Unless required by applicable law or agreed to in writing, software distributed under the License is distributed on an "AS IS" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied. See the License for the specific language governing permissions and limitations under the License.'),
    ("BSD-2-Clause", "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met:"),
    ("BSD-3-Clause", "Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from this software without specific prior written permission."),
    ("CC-BY-4.0", "This work is licensed under a Creative Commons Attribution 4.0 International License."),
    ("CC-BY-NC-4.0", "Licensed under CC BY-NC 4.0."),
    ("CC-BY-SA-4.0", "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License."),
    ("CC0-1.0", "The person who associated a work with this deed has dedicated the work to the public domain by waiving all of his or her rights to the work worldwide under copyright law"),
    ("GPL-3.0", "This work is licensed under the GNU General Public License, version 3."),
    ("GPL-3.0", "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version."),
    ("GPL-2.0", "This program is free software; you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation; either version 2 of the License, or (at your option) any later version."),
    ("ISC", "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the above copyright notice and this permission notice appear in all copies."),
    ("MIT", "Released under the MIT License."),
    ("MIT", 'Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the "Software"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the following conditions:'),
    ("MPL-2.0", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was not distributed with this file, You can obtain one at"),
    ("Unlicense", "This is free and unencumbered software released into the public domain. Anyone is free to copy, modify, publish, use, compile, sell, or distribute this software, either in source code form or as a compiled binary, for any purpose, commercial or non-commercial, and by any means."),
    ("SPDX-MIT", "SPDX-License-Identifier: MIT"),
    ("SPDX-Apache-2.0", "SPDX-License-Identifier: Apache-2.0"),
    ("SPDX-BSD-2-Clause", "SPDX-License-Identifier: BSD-2-Clause"),
    ("SPDX-BSD-3-Clause", "SPDX-License-Identifier: BSD-3-Clause"),
    ("SPDX-GPL-2.0", "SPDX-License-Identifier: GPL-2.0"),
    ("SPDX-GPL-3.0", "SPDX-License-Identifier: GPL-3.0"),
    ("SPDX-LGPL-2.1", "SPDX-License-Identifier: LGPL-2.1"),
    ("SPDX-LGPL-3.0", "SPDX-License-Identifier: LGPL-3.0"),
    ("SPDX-AGPL-3.0", "SPDX-License-Identifier: AGPL-3.0"),
    ("SPDX-MPL-2.0", "SPDX-License-Identifier: MPL-2.0"),
    ("SPDX-EPL-2.0", "SPDX-License-Identifier: EPL-2.0"),
    ("SPDX-BSL-1.0", "SPDX-License-Identifier: BSL-1.0"),
    ("MIT", 'Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the "Software"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the following conditions: The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software. THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE.'),
    ("ISC", 'Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the above copyright notice and this permission notice appear in all copies. THE SOFTWARE IS PROVIDED "AS IS" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING ALL IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL THE AUTHOR BE LIABLE FOR ANY SPECIAL, DIRECT, INDIRECT, OR CONSEQUENTIAL DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING FROM LOSS OF USE, DATA OR PROFITS, WHETHER IN AN ACTION OF CONTRACT, NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING OUT OF OR IN CONNECTION WITH THE USE OR PERFORMANCE OF THIS SOFTWARE.'),
    ("0BSD", "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted."),
    ("BSD-2-Clause", 'Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met: 1. Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer. 2. Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer in the documentation and/or other materials provided with the distribution. THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS "AS IS" AND ANY EXPRESS OR IMPLIED WARRANTIES, INCLUDING, BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE DISCLAIMED. IN NO EVENT SHALL THE COPYRIGHT HOLDER OR CONTRIBUTORS BE LIABLE FOR ANY DIRECT, INDIRECT, INCIDENTAL, SPECIAL, EXEMPLARY, OR CONSEQUENTIAL DAMAGES (INCLUDING, BUT NOT LIMITED TO, PROCUREMENT OF SUBSTITUTE GOODS OR SERVICES; LOSS OF USE, DATA, OR PROFITS; OR BUSINESS INTERRUPTION) HOWEVER CAUSED AND ON ANY THEORY OF LIABILITY, WHETHER IN CONTRACT, STRICT LIABILITY, OR TORT (INCLUDING NEGLIGENCE OR OTHERWISE) ARISING IN ANY WAY OUT OF THE USE OF THIS SOFTWARE, EVEN IF ADVISED OF THE POSSIBILITY OF SUCH DAMAGE.'),
    ("Zlib", "This software is provided 'as-is', without any express or implied warranty. In no event will the authors be held liable for any damages arising from the use of this software. Permission is granted to anyone to use this software for any purpose, including commercial applications, and to alter it and redistribute it freely, subject to the following restrictions: 1. The origin of this software must not be misrepresented; you must not claim that you wrote the original software. If you use this software in a product, an acknowledgment in the product documentation would be appreciated but is not required. 2. Altered source versions must be plainly marked as such, and must not be misrepresented as being the original software. 3. This notice may not be removed or altered from any source distribution."),
    ("BSL-1.0", 'Permission is hereby granted, free of charge, to any person or organization obtaining a copy of the software and accompanying documentation covered by this license (the "Software") to use, reproduce, display, distribute, execute, and transmit the Software, and to prepare derivative works of the Software, and to permit third-parties to whom the Software is furnished to do so, all subject to the following:'),
    ("LGPL-2.1", "This library is free software; you can redistribute it and/or modify it under the terms of the GNU Lesser General Public License as published by the Free Software Foundation; either version 2.1 of the License, or (at your option) any later version."),
    ("LGPL-3.0", "This program is free software: you can redistribute it and/or modify it under the terms of the GNU Lesser General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version."),
    ("AGPL-3.0", "This program is free software: you can redistribute it and/or modify it under the terms of the GNU Affero General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version."),
    ("EPL-2.0", "This program and the accompanying materials are made available under the terms of the Eclipse Public License 2.0 which is available at"),
    ("WTFPL", "Everyone is permitted to copy and distribute verbatim or modified copies of this license document, and changing it is allowed as long as the name is changed."),
    ("all-rights-reserved", "All rights reserved."),
)


def bands_for(jaccard: float, probability: float = COLLIDE) -> int:
    """Bands of one MinHash value each, of which at least one collides with this probability at this similarity."""
    return max(1, math.ceil(math.log(1 - probability) / math.log(1 - jaccard))) if jaccard < 1 else 1


@dataclass
class Template:
    name: str
    size: int  # words in a shingle: five, or all of a shorter template
    shingles: np.ndarray  # sorted, distinct
    length: int  # of all its shingles

    @property
    def block(self) -> int:
        """Shingles in a block: a power of two, so that templates share windows; a template spans two to four blocks."""
        return 1 << max(0, (self.length // 2).bit_length() - 1) if self.length > 3 else 1

    @property
    def blocks(self) -> int:
        """Blocks in a window: the template's own, one more for the way it lies across them, and one for insertions."""
        return -(-self.length // self.block) + 2 * (self.block > 1)

    @property
    def reach(self) -> int:
        """Shingles of a stretch that lies whole in one window wherever it begins: the most that a copy may take up."""
        return self.block * (self.blocks - 1) + 1 if self.block > 1 else self.length

    @property
    def least(self) -> float:
        """The least similarity of a window with a copy that holds ``CONTAINED`` of the shingles."""
        common = math.ceil(CONTAINED * len(self.shingles) - 1e-9)
        return common / (self.block * self.blocks + len(self.shingles) - common)


@dataclass
class Index:
    templates: list[Template]

    @classmethod
    def of(cls, rows: list[tuple[str, str | None]]) -> Index:
        hashes, at = plain_words(pa.array([t or "" for _, t in rows], pa.large_string()))
        out = []
        for (name, _), a, b in zip(rows, at[:-1], at[1:]):
            if b > a:
                size = min(SHINGLE, b - a)
                starts = np.arange(b - a - size + 1)
                own = Spans(hashes[a:b]).hash(starts, starts + size)
                out.append(Template(name, int(size), np.unique(own), len(own)))
        return cls(out)

    def classes(self) -> dict[tuple[int, int], dict[int, list[int]]]:
        """Templates by what their windows have in common: words in a shingle and shingles in a block, then blocks."""
        out: dict[tuple[int, int], dict[int, list[int]]] = {}
        for k, t in enumerate(self.templates):
            out.setdefault((t.size, t.block), {}).setdefault(t.blocks, []).append(k)
        return out


def _order(hashes: np.ndarray, band: int) -> np.ndarray:
    """The band's order of shingles: another multiplier each, over hashes that are random already."""
    return hashes * np.uint64((0xD1342543DE82EF95 * (2 * band + 1)) & 0xFFFFFFFFFFFFFFFF) ^ np.uint64((0x9E3779B97F4A7C15 * (band + 1)) & 0xFFFFFFFFFFFFFFFF)


def _retrieved(index: Index, hashes: dict[int, tuple[np.ndarray, np.ndarray]], n_rows: int) -> set[tuple[int, int]]:
    """(row, template) of which a window and the template agree in a band. Windows of more blocks grow from those of fewer."""
    out: set[tuple[int, int]] = set()
    for (size, block), widths in index.classes().items():
        own, own_row = hashes[size]
        if not len(own):
            continue
        counts = np.bincount(own_row, minlength=n_rows)
        in_blocks = -(-counts // block)
        padded = np.cumsum(in_blocks) - in_blocks
        first = np.cumsum(counts) - counts
        slot = np.arange(len(own)) - first[own_row] + padded[own_row] * block
        total = int(in_blocks.sum())
        block_row = np.repeat(np.arange(n_rows), in_blocks)
        cells = np.full(total * block, np.iinfo(np.uint64).max, np.uint64)
        bands = {w: bands_for(min(index.templates[k].least for k in members)) for w, members in widths.items()}
        for band in range(max(bands.values())):
            cells[slot] = _order(own, band)
            low = cells.reshape(total, block).min(1) if block > 1 else cells.copy()
            window, reach = low.copy(), 1
            for width in sorted(w for w in widths if band < bands[w]):
                while reach < min(width, total):  # windows end with their row: later blocks count only in the same one
                    same = block_row[reach:] == block_row[:-reach]
                    np.minimum(window[: total - reach], low[reach:], out=window[: total - reach], where=same)
                    reach += 1
                keys: dict[int, list[int]] = {}
                for k in widths[width]:
                    keys.setdefault(int(_order(index.templates[k].shingles, band).min()), []).append(k)
                sorted_keys = np.array(sorted(keys), np.uint64)
                at = np.minimum(np.searchsorted(sorted_keys, window), len(sorted_keys) - 1)
                for w in np.flatnonzero(sorted_keys[at] == window):
                    out.update((int(block_row[w]), k) for k in keys[int(window[w])])
    return out


def _verified(template: Template, own: np.ndarray) -> list[tuple[int, int, float]]:
    """Stretches of a text (its shingles in order) that contain the template: first word, end, share of its shingles.

    Of all stretches within the template's reach the one that holds most of its shingles is taken, of equal ones the
    shorter, then the earlier; then, of those that share no word with it, the next."""
    at = np.minimum(np.searchsorted(template.shingles, own), len(template.shingles) - 1)
    hit = np.flatnonzero(template.shingles[at] == own)
    least = CONTAINED * len(template.shingles)
    last = np.searchsorted(hit, hit + template.reach) - 1
    if not len(hit) or (last - np.arange(len(hit)) + 1).max() < least:
        return []
    which, held, distinct, end = at[hit].tolist(), {}, 0, -1
    found = []
    for i, j in enumerate(last.tolist()):
        while end < j:
            end += 1
            held[which[end]] = held.get(which[end], 0) + 1
            distinct += held[which[end]] == 1
        if distinct >= least:
            found.append((i, j, distinct))
        held[which[i]] -= 1
        distinct -= held[which[i]] == 0
    stretches = []
    for i, j, distinct in found:
        seen: set[int] = set()
        for k in range(i, j + 1):  # the end comes nearer as long as no shingle is lost
            seen.add(which[k])
            if len(seen) == distinct:
                break
        stretches.append((-distinct, int(hit[k] - hit[i]), int(hit[i]), int(hit[k]) + template.size))
    out: list[tuple[int, int, float]] = []
    taken: list[tuple[int, int]] = []
    for distinct, _, first, stop in sorted(stretches):
        place = bisect.bisect(taken, (first, stop))
        if (place == 0 or taken[place - 1][1] <= first) and (place == len(taken) or stop <= taken[place][0]):
            taken.insert(place, (first, stop))
            out.append((first, stop, -distinct / len(template.shingles)))
    return sorted(out)


def _blocks(templates: DataFrame, most: int) -> Iterator[list[tuple[str, str | None]]]:
    """Templates in blocks of about ``most`` characters, read block by block."""
    held, size = [], 0
    for r in templates.select("license", "text").toLocalIterator():
        held.append((r["license"], r["text"]))
        size += len(r["text"] or "")
        if size >= most:
            yield held
            held, size = [], 0
    yield held


def with_licenses(docs: DataFrame, templates: DataFrame | None = None, most: int = MOST_CHARS) -> DataFrame:
    """``docs`` with ``licenses``: license, start, end (in words) and containment of every stretch that holds a template,
    in order of their start.

    ``templates`` has license and text; by default it is the list above. Words are runs of letters and digits in lower
    case. Null and empty texts hold none, nor does a template without a word match; a column named ``licenses`` is
    replaced, other columns and repeated rows pass through, an empty table gives an empty one. Stretches of one template
    share no word. Templates beyond ``most`` characters are taken in blocks; between blocks the documents are written.
    """
    docs = docs.drop("licenses").withColumn("text", F.col("text").cast("string"))
    blocks = _blocks(templates, most) if templates is not None else iter([list(TEMPLATES)])
    more = StructType.fromDDL("licenses array<struct<license:string,start:int,end:int,containment:double>>")
    out, first = docs, True
    for rows in blocks:
        if not (rows or first):
            break
        if not first:
            out = materialise(out, "licenses")
        index = Index.of(rows)
        out, first = out.mapInArrow(_scan(index, first), StructType([*docs.schema.fields, *more.fields])), False
    return out


def _scan(index: Index, first: bool):
    """Add the matches of one block of templates to what the rows have."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sizes = sorted({t.size for t in index.templates})
        for batch in slices(batches):
            words, at = plain_words(batch.column(batch.schema.get_field_index("text")).fill_null(""))
            spans, hashes = Spans(words), {}
            for size in sizes:
                starts = np.arange(max(0, len(words) - size + 1))
                row = np.searchsorted(at, starts, "right") - 1
                inside = starts + size <= at[row + 1] if len(starts) else np.zeros(0, bool)
                hashes[size] = spans.hash(starts[inside], starts[inside] + size), row[inside]
            columns, names = list(batch.columns), list(batch.schema.names)
            found: list[list[dict]] = [[] for _ in range(batch.num_rows)] if first else columns.pop().to_pylist()
            names = names if first else names[:-1]
            for r, k in sorted(_retrieved(index, hashes, batch.num_rows)):
                template = index.templates[k]
                own, own_row = hashes[template.size]
                a, b = np.searchsorted(own_row, [r, r + 1])
                for start, end, share in _verified(template, own[a:b]):
                    found[r].append({"license": template.name, "start": start, "end": end, "containment": share})
            for matches in found:
                matches.sort(key=lambda x: (x["start"], x["end"], x["license"]))
            kind = pa.list_(pa.struct([("license", pa.string()), ("start", pa.int32()), ("end", pa.int32()), ("containment", pa.float64())]))
            yield pa.RecordBatch.from_arrays([*columns, pa.array(found, kind)], [*names, "licenses"])

    return work


def license_rows(docs: DataFrame) -> DataFrame:
    """One row for each stretch: doc_id, license, start, end, containment."""
    return with_licenses(docs.select("doc_id", "text")).select("doc_id", F.inline("licenses"))
