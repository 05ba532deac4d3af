"""License scans by patience alignment with templates.

Words (runs of letters and digits, lower case) of a text and of every template. Where a
stretch of at most ``SPREAD`` times a template's length has as many template
words as the wanted coverage needs, it is a candidate (an exact bound: fewer words cannot give that coverage); stretches
that touch are one region. A region is aligned with the template: words unique to both are anchors,
their longest increasing subsequence is kept, gaps between anchors are aligned in the same way, and equal words at the edges of
a gap are matched. Matched words over template words is the coverage. After a hit the rest of
the region is scanned on, so every occurrence counts.

Membership counts are numpy over a batch; Python runs for candidate regions only.
"""

from __future__ import annotations

from bisect import bisect_left
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from notchline.llm.common import table
from notchline.llm.pretokens import STEP, pieces_of

COVERAGE = 0.85
SPREAD = 2
GROUP = 62  # templates a row of bits

# Notices and texts of public licenses, as their owners word them
TEMPLATES = {
    "Apache-2.0": "Licensed under the Apache License, Version 2.0",
    "Apache-2.0-header": "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in compliance with the License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0 Unless required by applicable law or agreed to in writing, software distributed under the License is distributed on an \"AS IS\" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied.",
    "MIT": "Released under the MIT License",
    "MIT-text": "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the \"Software\"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the following conditions: The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software.",
    "ISC-text": "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the above copyright notice and this permission notice appear in all copies.",
    "BSD-2-text": "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met: Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer. Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer in the documentation and/or other materials provided with the distribution.",
    "GPL-3.0": "This work is licensed under the GNU General Public License, version 3",
    "GPL-3.0-header": "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version.",
    "CC-BY-4.0": "Licensed under CC BY 4.0",
    "CC-BY-SA-4.0": "Licensed under CC BY-SA 4.0",
    "CC-BY-NC-4.0": "Licensed under CC BY-NC 4.0",
    "all-rights-reserved": "All rights reserved",
    "BSD-3-text": "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met: 1. Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer. 2. Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer in the documentation and/or other materials provided with the distribution. 3. Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from this software without specific prior written permission. THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS \"AS IS\" AND ANY EXPRESS OR IMPLIED WARRANTIES, INCLUDING, BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE DISCLAIMED. IN NO EVENT SHALL THE COPYRIGHT HOLDER OR CONTRIBUTORS BE LIABLE FOR ANY DIRECT, INDIRECT, INCIDENTAL, SPECIAL, EXEMPLARY, OR CONSEQUENTIAL DAMAGES (INCLUDING, BUT NOT LIMITED TO, PROCUREMENT OF SUBSTITUTE GOODS OR SERVICES; LOSS OF USE, DATA, OR PROFITS; OR BUSINESS INTERRUPTION) HOWEVER CAUSED AND ON ANY THEORY OF LIABILITY, WHETHER IN CONTRACT, STRICT LIABILITY, OR TORT (INCLUDING NEGLIGENCE OR OTHERWISE) ARISING IN ANY WAY OUT OF THE USE OF THIS SOFTWARE, EVEN IF ADVISED OF THE POSSIBILITY OF SUCH DAMAGE.",
    "MPL-2.0-header": "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was not distributed with this file, You can obtain one at https://mozilla.org/MPL/2.0/.",
    "GPL-2.0-header": "This program is free software; you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation; either version 2 of the License, or (at your option) any later version.",
    "LGPL-2.1-header": "This library is free software; you can redistribute it and/or modify it under the terms of the GNU Lesser General Public License as published by the Free Software Foundation; either version 2.1 of the License, or (at your option) any later version. This library is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; without even the implied warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE. See the GNU Lesser General Public License for more details.",
    "AGPL-3.0-header": "This program is free software: you can redistribute it and/or modify it under the terms of the GNU Affero General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version. This program is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; without even the implied warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE. See the GNU Affero General Public License for more details.",
    "EPL-2.0-header": "This program and the accompanying materials are made available under the terms of the Eclipse Public License 2.0 which is available at https://www.eclipse.org/legal/epl-2.0/",
    "Unlicense": "This is free and unencumbered software released into the public domain. Anyone is free to copy, modify, publish, use, compile, sell, or distribute this software, either in source code form or as a compiled binary, for any purpose, commercial or non-commercial, and by any means. In jurisdictions that recognize copyright laws, the author or authors of this software dedicate any and all copyright interest in the software to the public domain. We make this dedication for the benefit of the public at large and to the detriment of our heirs and successors. We intend this dedication to be an overt act of relinquishment in perpetuity of all present and future rights to this software under copyright law.",
    "BSL-1.0-header": "Distributed under the Boost Software License, Version 1.0. (See accompanying file LICENSE_1_0.txt or copy at https://www.boost.org/LICENSE_1_0.txt)",
    "Zlib-text": "This software is provided 'as-is', without any express or implied warranty. In no event will the authors be held liable for any damages arising from the use of this software. Permission is granted to anyone to use this software for any purpose, including commercial applications, and to alter it and redistribute it freely, subject to the following restrictions: 1. The origin of this software must not be misrepresented; you must not claim that you wrote the original software. If you use this software in a product, an acknowledgment in the product documentation would be appreciated but is not required. 2. Altered source versions must be plainly marked as such, and must not be misrepresented as being the original software. 3. This notice may not be removed or altered from any source distribution.",
    "CC0-1.0": "To the extent possible under law, the author has waived all copyright and related or neighboring rights to this work.",
}


def words(text: str) -> list[str]:
    import regex

    return regex.findall(r"[\p{L}\p{N}]+", text.lower())


def _rising(pairs: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """The longest subsequence of (i, j), ascending in i, that ascends in j."""
    tails, at, back = [], [], [-1] * len(pairs)
    for k, (_, j) in enumerate(pairs):
        p = bisect_left(tails, j)
        back[k] = at[p - 1] if p else -1
        tails[p : p + 1], at[p : p + 1] = [j], [k]
    out, k = [], at[-1] if at else -1
    while k >= 0:
        out.append(pairs[k])
        k = back[k]
    return out[::-1]


def align(text: list[str], template: list[str]) -> list[tuple[int, int]]:
    """Matched (text, template) positions of a patience alignment, ascending."""
    found, gaps = [], [(0, len(text), 0, len(template))]
    while gaps:
        a, b, c, d = gaps.pop()
        while a < b and c < d and text[a] == template[c]:
            found.append((a, c))
            a, c = a + 1, c + 1
        while a < b and c < d and text[b - 1] == template[d - 1]:
            found.append((b - 1, d - 1))
            b, d = b - 1, d - 1
        if a >= b or c >= d:
            continue
        n_text, n_template = Counter(text[a:b]), Counter(template[c:d])
        place = {w: c + k for k, w in enumerate(template[c:d])}
        anchors = _rising([(a + k, place[w]) for k, w in enumerate(text[a:b]) if n_text[w] == 1 and n_template.get(w) == 1])
        if not anchors:
            continue
        found += anchors
        edges = [(a - 1, c - 1), *anchors, (b, d)]
        gaps += [(i + 1, k, j + 1, m) for (i, j), (k, m) in zip(edges, edges[1:], strict=False)]
    return sorted(found)


class Scanner:
    """Templates, any number of them, and which of them have a word."""

    def __init__(self, templates: dict[str, str], coverage: float):
        self.names = list(templates)
        self.words = [words(t) for t in templates.values()]
        if not all(self.words):
            raise ValueError("every template needs a word")
        self.need = [int(np.ceil(coverage * len(w) - 1e-9)) for w in self.words]
        self.mask: dict[str, int] = {}
        for k, ws in enumerate(self.words):
            for w in ws:
                self.mask[w] = self.mask.get(w, 0) | 1 << k

    def masks_of(self, vocabulary: list[str]) -> np.ndarray:
        """Which templates have each word: a row of 62 bits for every 62 templates."""
        have = [self.mask.get(w, 0) for w in vocabulary]
        return np.array([[m >> s & (1 << GROUP) - 1 for m in have] for s in range(0, len(self.names), GROUP)], dtype=np.int64).reshape(-1, len(have))

    def candidates(self, masks: np.ndarray, ends: np.ndarray) -> Iterator[tuple[int, int, int]]:
        """(template, start, end) of regions of ``masks`` (as of ``masks_of``, by word place); ``ends``: where each word's text ends."""
        groups = [(np.flatnonzero(m), m) for m in np.atleast_2d(masks)]
        groups = [(has, m[has], ends[has]) for has, m in groups]
        for k, ws in enumerate(self.words):
            has, own, stop = groups[k // GROUP]
            mine = own >> k % GROUP & 1 == 1
            at, upto = has[mine], stop[mine]
            if len(at) < self.need[k]:
                continue
            reach = np.minimum(at + SPREAD * len(ws), upto)
            count = np.searchsorted(at, reach) - np.arange(len(at))
            good = np.flatnonzero(count >= self.need[k])
            if not len(good):
                continue
            start, reach, upto = at[good], reach[good], upto[good]
            first = np.flatnonzero(np.concatenate([[True], (start[1:] >= reach[:-1]) | (upto[1:] != upto[:-1])]))
            for s, e in zip(start[first].tolist(), reach[np.concatenate([first[1:] - 1, [len(reach) - 1]])].tolist(), strict=True):
                yield k, s, e

    def hits(self, k: int, region: list[str]) -> Iterator[tuple[int, int, float]]:
        """(start, end, coverage) of the template's occurrences in a region."""
        template = self.words[k]
        begin = 0
        while len(region) - begin >= self.need[k]:
            near = self._first(k, region, begin)
            if near is None:
                return
            s, e = near
            found = align(region[s:e], template)
            if len(found) >= self.need[k]:
                yield s + found[0][0], s + found[-1][0] + 1, len(found) / len(template)
                begin = s + found[-1][0] + 1
            else:
                begin = s + 1

    def _first(self, k: int, region: list[str], begin: int) -> tuple[int, int] | None:
        """The first stretch from ``begin`` on with enough of the template's words, repeats
        counted no more often than the template has them."""
        have, template = Counter(), Counter(self.words[k])
        length, enough, s, n = SPREAD * len(self.words[k]), self.need[k], begin, 0
        for e in range(begin, len(region)):
            w = region[e]
            have[w] += 1
            n += have[w] <= template.get(w, 0)
            while e - s >= length or region[s] not in template and s < e:
                n -= have[region[s]] <= template.get(region[s], 0)
                have[region[s]] -= 1
                s += 1
            if n >= enough:
                return s, min(len(region), s + length)
        return None


def scan_licenses(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", templates: dict[str, str] | None = None, coverage: float = COVERAGE) -> DataFrame:
    """(id, n_hits, licenses): one row for each row of ``docs``; ``licenses`` lists (license,
    start, end, coverage), word positions, by start; of hits that overlap the one with more
    matched words stays (ties: the higher coverage, then the name). Null and empty texts have none;
    repeated rows are scanned each; other columns are not read."""
    scanner = Scanner(templates or TEMPLATES, coverage)

    def best(found: list[tuple[int, int, int, float]]) -> list[dict]:
        kept: list[tuple[int, int, int, float]] = []
        for k, s, e, c in sorted(found, key=lambda x: (-round(x[3] * len(scanner.words[x[0]])), -x[3], scanner.names[x[0]], x[1])):
            if all(e <= s2 or e2 <= s for _, s2, e2, _ in kept):
                kept.append((k, s, e, c))
        return [{"license": scanner.names[k], "start": s, "end": e, "coverage": c} for k, s, e, c in sorted(kept, key=lambda x: x[1])]

    struct = pa.struct([("license", pa.string()), ("start", pa.int32()), ("end", pa.int32()), ("coverage", pa.float64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            off = b.column(1).offsets.to_numpy().astype(np.int64)
            row = 0
            while row < b.num_rows:
                end = max(row + 1, int(np.searchsorted(off, off[row] + STEP, side="right")) - 1)
                enc = b.column(1).values.slice(int(off[row]), int(off[end] - off[row])).dictionary_encode()
                names, at = enc.dictionary, enc.indices.to_numpy(zero_copy_only=False)
                masks = scanner.masks_of(names.to_pylist())[:, at]
                cut = off[row : end + 1] - off[row]
                ends = np.repeat(cut[1:], np.diff(cut))
                hits: dict[int, list] = {}
                for k, s, e in scanner.candidates(masks, ends):
                    doc = int(np.searchsorted(cut, s, side="right")) - 1
                    region = names.take(pa.array(at[s:e])).to_pylist()
                    for x, y, c in scanner.hits(k, region):
                        hits.setdefault(doc, []).append((k, s + x - int(cut[doc]), s + y - int(cut[doc]), c))
                lists = [best(hits[i]) if i in hits else [] for i in range(end - row)]
                yield pa.RecordBatch.from_arrays([b.column(0).slice(row, end - row), pa.array([len(x) for x in lists], type=pa.int32()), pa.array(lists, type=pa.list_(struct))], names=["id", "n_hits", "licenses"])
                row = end

    hit = T.StructType([T.StructField("license", T.StringType()), T.StructField("start", T.IntegerType()), T.StructField("end", T.IntegerType()), T.StructField("coverage", T.DoubleType())])
    schema = T.StructType([T.StructField("id", docs.schema[doc_id].dataType), T.StructField("n_hits", T.IntegerType()), T.StructField("licenses", T.ArrayType(hit))])
    split = F.regexp_extract_all(F.lower(F.col("text")), F.lit(r"[\p{L}\p{N}]+"), F.lit(0))
    return pieces_of(docs, None, doc_id, text, split).select("id", "pieces").mapInArrow(run, schema)


def op10_license_patience(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scan_licenses(table(spark, sf_dir, "documents")).withColumnRenamed("id", "doc_id")


QUERIES = {"op10_license_patience": op10_license_patience}
ORACLE: dict[str, str] = {}
