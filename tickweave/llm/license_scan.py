"""License scans: which template texts occur in a document, how much of them, and where.

Words are runs of letters and digits, lower-cased.  Of the hashes of all runs of
``GRAM`` words of a template a window of ``WINDOW`` keeps the smallest
(winnowing); a template of fewer words has one fingerprint, all its words.  The
fingerprints, an inverted index (value, template, place), are made in tasks and
written as a table.  All runs of a document are looked up, so any passage of
``GRAM + WINDOW - 1`` words of a template, or a whole shorter template, is a
candidate.

The documents are scanned once, however many templates there are.  The scan
passes the runs whose value a bit filter of the index holds (of a fixed greatest
size; a false pass costs a lookup, and none is missed), and only those are joined
with the index by value.  The places of a pair of document and template give its
diagonals.  Candidates meet the text of their document again in a task, where
they are aligned word by word inside a band around the diagonal, which gives the
matched words, their share of the template (coverage) and their span in the
document, and so again outside the spans found until no candidate is left.  A
template is in a document if its spans together match enough of its words; one
of fewer than ``GRAM`` words only as a whole.

Nothing of a template or a document goes through the driver, but the filter's bits.
"""

from __future__ import annotations

import functools
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tickweave.llm.common import map_arrow, steps, text_col, written
from tickweave.llm.pieces import LETTER, NUMBER, char_kinds, runs, span_hashes, text_edges

GRAM = 5
WINDOW = 4
#: Words that the alignment may be off a diagonal.
BAND = 16
#: Least share of a template's words that its matches in a document must cover together.
MIN_COVERAGE = 0.5
#: Bits of the filter for each fingerprint, and most bits of it as a power of two (16 MB).
FILTER_BITS, MOST_BITS = 1024, 27
#: Fixed value: the bits of one of Spark's bitmaps.
BITMAP = 32768
#: Rows up to which the index, and words of templates up to which their table, are broadcast (8 to 24 bytes each).
BROADCAST_ROWS = 1 << 20
MATCH, MISMATCH, GAP = 2, -2, -1
RESULT = "doc_id long, template_id string, coverage double, matched_words long, template_words long, start long, end long"
NAMES = [c.split()[0] for c in RESULT.split(", ")]
TYPES = [pa.int64(), pa.string(), pa.float64(), *[pa.int64()] * 4]

#: The grant and the rest of the MIT license.
MIT_GRANT = """Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated
documentation files (the "Software"), to deal in the Software without restriction, including without limitation the rights to
use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the
Software is furnished to do so, subject to the following conditions:"""
MIT_REST = """The above copyright notice and this permission notice shall
be included in all copies or substantial portions of the Software. THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY
KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND
NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER
IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS
IN THE SOFTWARE."""
#: The conditions and the disclaimer of the BSD licenses.
BSD_TWO = """Redistribution and use in source and binary forms, with or without modification, are permitted provided that the
following conditions are met: 1. Redistributions of source code must retain the above copyright notice, this list of conditions and
the following disclaimer. 2. Redistributions in binary form must reproduce the above copyright notice, this list of conditions and
the following disclaimer in the documentation and/or other materials provided with the distribution."""
BSD_THIRD = """3. Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote
products derived from this software without specific prior written permission."""
BSD_REST = """THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS "AS IS" AND ANY EXPRESS OR IMPLIED WARRANTIES,
INCLUDING, BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE DISCLAIMED. IN NO
EVENT SHALL THE COPYRIGHT HOLDER OR CONTRIBUTORS BE LIABLE FOR ANY DIRECT, INDIRECT, INCIDENTAL, SPECIAL, EXEMPLARY, OR
CONSEQUENTIAL DAMAGES (INCLUDING, BUT NOT LIMITED TO, PROCUREMENT OF SUBSTITUTE GOODS OR SERVICES; LOSS OF USE, DATA, OR PROFITS; OR
BUSINESS INTERRUPTION) HOWEVER CAUSED AND ON ANY THEORY OF LIABILITY, WHETHER IN CONTRACT, STRICT LIABILITY, OR TORT (INCLUDING
NEGLIGENCE OR OTHERWISE) ARISING IN ANY WAY OUT OF THE USE OF THIS SOFTWARE, EVEN IF ADVISED OF THE POSSIBILITY OF SUCH DAMAGE."""

#: Notices of public licenses, and the lines that name one.
NOTICES = {
    "MIT line": "Released under the MIT License.",
    "MIT line 2": "Licensed under the MIT License.",
    "Apache-2.0 line": "Licensed under the Apache License, Version 2.0.",
    "Apache-2.0 line 2": "Licensed under the Apache License 2.0.",
    "GPL-3.0 line": "This work is licensed under the GNU General Public License, version 3.",
    "GPL-2.0 line": "Licensed under the GNU General Public License, version 2.",
    "BSD line": "Use of this source code is governed by a BSD-style license that can be found in the LICENSE file.",
    "CC0-1.0 line": "To the extent possible under law, the author has waived all copyright and related or neighboring rights to this work.",
    "MIT grant": MIT_GRANT,
    "MIT": f"{MIT_GRANT} {MIT_REST}",
    "BSD-2-Clause": f"{BSD_TWO} {BSD_REST}",
    "BSD-3-Clause": f"{BSD_TWO} {BSD_THIRD} {BSD_REST}",
    "Zlib": """This software is provided 'as-is', without any express or implied warranty. In no event will the authors be held
liable for any damages arising from the use of this software. Permission is granted to anyone to use this software for any purpose,
including commercial applications, and to alter it and redistribute it freely, subject to the following restrictions: 1. The origin
of this software must not be misrepresented; you must not claim that you wrote the original software. If you use this software in a
product, an acknowledgment in the product documentation would be appreciated but is not required. 2. Altered source versions must be
plainly marked as such, and must not be misrepresented as being the original software. 3. This notice may not be removed or altered
from any source distribution.""",
    "Unlicense": """This is free and unencumbered software released into the public domain. Anyone is free to copy, modify, publish,
use, compile, sell, or distribute this software, either in source code form or as a compiled binary, for any purpose, commercial or
non-commercial, and by any means.""",
    "MPL-2.0 notice": """This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was
not distributed with this file, You can obtain one at http://mozilla.org/MPL/2.0/.""",
    "BSL-1.0 notice": """Distributed under the Boost Software License, Version 1.0. (See accompanying file LICENSE_1_0.txt or copy at
http://www.boost.org/LICENSE_1_0.txt)""",
    "EPL-2.0 notice": """This program and the accompanying materials are made available under the terms of the Eclipse Public License
2.0 which is available at https://www.eclipse.org/legal/epl-2.0/""",
    "LGPL-3.0 notice": """This library is free software: you can redistribute it and/or modify it under the terms of the GNU Lesser
General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later
version.""",
    "AGPL-3.0 notice": """This program is free software: you can redistribute it and/or modify it under the terms of the GNU Affero
General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later
version.""",
    "GPL-2.0 notice": """This program is free software; you can redistribute it and/or modify it under the terms of the GNU General
Public License as published by the Free Software Foundation; either version 2 of the License, or (at your option) any later
version.""",
    "ISC": """Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby
granted, provided that the above copyright notice and this permission notice appear in all copies. THE SOFTWARE IS PROVIDED "AS IS"
AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING ALL IMPLIED WARRANTIES OF MERCHANTABILITY AND
FITNESS. IN NO EVENT SHALL THE AUTHOR BE LIABLE FOR ANY SPECIAL, DIRECT, INDIRECT, OR CONSEQUENTIAL DAMAGES OR ANY DAMAGES
WHATSOEVER RESULTING FROM LOSS OF USE, DATA OR PROFITS, WHETHER IN AN ACTION OF CONTRACT, NEGLIGENCE OR OTHER TORTIOUS ACTION,
ARISING OUT OF OR IN CONNECTION WITH THE USE OR PERFORMANCE OF THIS SOFTWARE.""",
    "Apache-2.0 notice": """Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in
compliance with the License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0 Unless required by
applicable law or agreed to in writing, software distributed under the License is distributed on an "AS IS" BASIS, WITHOUT
WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied. See the License for the specific language governing permissions
and limitations under the License.""",
    "GPL-3.0 notice": """This program is free software: you can redistribute it and/or modify it under the terms of the GNU General
Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later
version. This program is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; without even the implied
warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE. See the GNU General Public License for more details. You should
have received a copy of the GNU General Public License along with this program.""",
}
#: Creative Commons licenses and their names.
CREATIVE = {"BY": "Attribution", "BY-SA": "Attribution-ShareAlike", "BY-NC": "Attribution-NonCommercial", "BY-ND": "Attribution-NoDerivatives",
            "BY-NC-SA": "Attribution-NonCommercial-ShareAlike", "BY-NC-ND": "Attribution-NonCommercial-NoDerivatives"}
#: Identifiers that an SPDX tag may name.
SPDX = ("0BSD", "AGPL-3.0-only", "AGPL-3.0-or-later", "Apache-2.0", "BSD-2-Clause", "BSD-3-Clause", "BSL-1.0", "CC-BY-4.0", "CC-BY-SA-4.0",
        "CC0-1.0", "EPL-2.0", "GPL-2.0-only", "GPL-2.0-or-later", "GPL-3.0-only", "GPL-3.0-or-later", "ISC", "LGPL-2.1-only",
        "LGPL-2.1-or-later", "LGPL-3.0-only", "LGPL-3.0-or-later", "MIT", "MPL-2.0", "Unlicense", "WTFPL", "Zlib")
NOTICES |= {f"CC-{k}-4.0 line": f"Licensed under CC {k} 4.0." for k in CREATIVE}
NOTICES |= {f"CC-{k}-4.0 notice": f"This work is licensed under a Creative Commons {v} 4.0 International License." for k, v in CREATIVE.items()}
NOTICES |= {f"{k} tag": f"SPDX-License-Identifier: {k}" for k in SPDX}


@functools.lru_cache(1)
def _lower() -> np.ndarray:
    """The lower case of each code point that has one of a single code point."""
    table = np.arange(0x110000, dtype=np.uint32)
    for c in range(0x110000):
        low = chr(c).lower()
        if len(low) == 1:
            table[c] = ord(low)
    return table


def words(texts: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Hashes, starts and stops of all words, each word's text, and the edges of the texts."""
    code = np.frombuffer("".join(texts).encode("utf-32-le"), "<u4")
    edges = text_edges(texts)
    kind = char_kinds()[code]
    starts, stops = runs((kind == LETTER) | (kind == NUMBER), edges)
    hashes = span_hashes(_lower()[code], starts, stops)[0]
    return hashes, starts, stops, np.searchsorted(edges, starts, "right") - 1, edges


def grams(hashes: np.ndarray, owner: np.ndarray, length: int = GRAM) -> tuple[np.ndarray, np.ndarray]:
    """All runs of ``length`` words inside a text: places of their first words, and values."""
    n = len(hashes) - length + 1
    if n < 1:
        return np.zeros(0, np.int64), np.zeros(0, np.uint64)
    gram = np.full(n, length, np.uint64)
    for k in range(length):
        gram = gram * np.uint64(0x9E3779B97F4A7C15) + hashes[k: k + n]
        gram ^= gram >> np.uint64(29)
    whole = owner[:n] == owner[length - 1:]
    return np.flatnonzero(whole), gram[whole]


def winnow(hashes: np.ndarray, owner: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The fingerprints among the grams.  A text shorter than a window keeps its
    smallest gram."""
    place, gram = grams(hashes, owner)
    if not len(place):
        return place, gram
    owner = owner[place]
    # A gram stays if it is the last smallest one of a window of its text.
    keep, m = np.zeros(len(gram), bool), len(gram)
    first = np.searchsorted(owner, owner)
    last = np.searchsorted(owner, owner, "right") - 1
    begin = np.arange(m)
    begin = begin[(begin == first) | (begin + WINDOW - 1 <= last)]
    best, low = begin.copy(), gram[begin]
    for k in range(1, WINDOW):
        at = np.minimum(begin + k, m - 1)
        better = (begin + k <= last[begin]) & (gram[at] <= low)
        best[better], low[better] = at[better], gram[at[better]]
    keep[best] = True
    return place[keep], gram[keep]


def align(template: np.ndarray, doc: np.ndarray, diagonal: int, band: int = BAND) -> tuple[np.ndarray, int, int]:
    """The matched places of ``template``, and the first and last matched place in
    ``doc``, of the best local alignment of two word sequences whose places differ
    by ``diagonal`` give or take ``band``."""
    m, n, width = len(template), len(doc), 2 * band + 1
    if 0 <= diagonal and diagonal + m <= n and np.array_equal(doc[diagonal: diagonal + m], template):
        return np.arange(m), diagonal, diagonal + m - 1
    offset = np.arange(width)
    score = np.zeros((m + 1, width + 1), np.int32)  # score[i + 1, d]: template place i, document place i + diagonal - band + d
    hit = np.zeros((m, width), bool)
    for i in range(m):
        at = offset + i + diagonal - band
        inside = (at >= 0) & (at < n)
        hit[i] = inside & (doc[np.clip(at, 0, n - 1)] == template[i])
        row = np.maximum(score[i, :width] + np.where(hit[i], MATCH, MISMATCH), score[i, 1:] + GAP)
        row = np.where(inside, np.maximum(row, 0), 0)
        score[i + 1, :width] = np.maximum.accumulate(row - GAP * offset) + GAP * offset
    end = int(np.argmax(score[:, :width]))
    i, d = divmod(end, width)
    matched, first, last = [], -1, -1
    while i > 0 and d >= 0 and score[i, d] > 0:
        if hit[i - 1, d] and score[i, d] == score[i - 1, d] + MATCH:
            at = i - 1 + diagonal - band + d
            first, last = at, at if last < 0 else last
            i -= 1
            matched.append(i)
        elif score[i, d] == score[i - 1, d] + MISMATCH:
            i -= 1
        elif score[i, d] == score[i - 1, d + 1] + GAP:
            i, d = i - 1, d + 1
        elif d and score[i, d] == score[i, d - 1] + GAP:
            d -= 1
        else:
            break
    return np.array(matched[::-1], np.int64), first, last


def spans(template: np.ndarray, doc: np.ndarray, place: np.ndarray, diagonal: np.ndarray, band: int = BAND) -> list[tuple[np.ndarray, int, int]]:
    """Alignments that don't overlap in ``doc``, as many as it takes to leave no
    hit outside them; hits are runs of GRAM words from ``place`` (ascending) on.

    Whole copies come first.  What is left of the document is aligned around its
    first hit, then what is left before and behind that, and so on.  A template
    of fewer than GRAM words is found as a whole or not at all.
    """
    m, found, free, rest = len(template), [], 0, []
    for d in np.unique(diagonal).tolist():
        if free <= d <= len(doc) - m and np.array_equal(doc[d: d + m], template):
            found.append((np.arange(m), d, d + m - 1))
            rest.append((free, d))
            free = d + m
    if m < GRAM:
        return found
    rest.append((free, len(doc)))
    while rest:
        low, high = rest.pop()
        a = int(np.searchsorted(place, low))
        b = int(np.searchsorted(place, high - GRAM, "right"))
        if a >= b:
            continue
        b = min(b, int(np.searchsorted(place, place[a] + m + band, "right")))
        near = np.sort(diagonal[a:b][np.abs(diagonal[a:b] - diagonal[a]) <= band])
        matched, first, last = align(template, doc[low:high], int(near[len(near) // 2]) - low, band)
        if not len(matched):  # equal hashes of other words
            rest.append((int(place[a]) + 1, high))
            continue
        found.append((matched, low + first, low + last))
        rest += [(low, low + first), (low + last + 1, high)]
    return found


def notice_templates(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame([(f"license:{k}", v) for k, v in NOTICES.items()], "template_id string, text string")


def index_templates(templates: DataFrame) -> DataFrame:
    """The words (hashes) and fingerprints of each row of ``templates``, as a
    written table: ``t_id``, ``template_id``, ``t_n``, ``t_words``, ``value``, ``place``."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, texts in steps(batches):
            hashes, _, _, owner, _ = words(texts)
            bounds = np.searchsorted(owner, np.arange(len(texts) + 1))
            size = np.diff(bounds)
            found = [winnow(hashes, owner)]
            for k in range(1, GRAM):
                place, value = grams(hashes, owner, k)
                whole = size[owner[place]] == k
                found.append((place[whole], value[whole]))
            place, value = (np.concatenate(x) for x in zip(*found))
            order = np.argsort(place, kind="stable")
            place, value = place[order], value[order]
            offsets = pa.array(np.searchsorted(owner[place], np.arange(len(texts) + 1)), pa.int32())
            yield pa.RecordBatch.from_arrays([
                batch.column("template_id"), pa.array(size, pa.int64()), pa.array([hashes[a:b].tobytes() for a, b in zip(bounds, bounds[1:])], pa.binary()),
                pa.ListArray.from_arrays(offsets, pa.array(value.view(np.int64))),
                pa.ListArray.from_arrays(offsets, pa.array(place - bounds[owner[place]]))], names=["template_id", "t_n", "t_words", "value", "place"])

    rows = templates.select(F.col("template_id").cast("string").alias("template_id"), text_col().alias("text"))
    table = map_arrow(rows, run, "template_id string, t_n long, t_words binary, value array<long>, place array<long>")
    return written(table.withColumn("t_id", F.monotonically_increasing_id()), "license-index")


def _filter(index: DataFrame, n: int) -> tuple[np.ndarray, int]:
    """A bit set of the index's values (two bits each) and the power of two of its length."""
    power = min(MOST_BITS, max((FILTER_BITS * n).bit_length(), BITMAP.bit_length() - 1))
    bits_of = F.array(F.shiftrightunsigned("value", 64 - power) + 1, F.col("value").bitwiseAND(F.lit((1 << power) - 1)) + 1)
    parts = index.select(F.explode(bits_of).alias("bit")).groupBy(F.bitmap_bucket_number("bit").alias("part")).agg(
        F.bitmap_construct_agg(F.bitmap_bit_position("bit")).alias("bits"))
    bits = np.zeros(1 << power - 3, np.uint8)
    for r in parts.collect():
        at = (r["part"] - 1) * (BITMAP // 8)
        bits[at: at + len(r["bits"])] = np.frombuffer(r["bits"], np.uint8)
    return bits, power


def _passed(value: np.ndarray, bits: np.ndarray, power: int) -> np.ndarray:
    """Which values have both their bits in the filter."""
    high, low = value >> np.uint64(64 - power), value & np.uint64((1 << power) - 1)
    return np.logical_and(*(bits[x >> np.uint64(3)] >> (x & np.uint64(7)).astype(np.uint8) & 1 for x in (high, low)))


def _looked_up(rows: DataFrame, bits: np.ndarray, power: int, lengths: list[int]) -> DataFrame:
    """The documents with runs that pass the filter, and these runs: ``row`` (a
    number of the row), ``doc_id``, ``text``, ``value``, ``place``.  A written table."""
    held = rows.sparkSession.sparkContext.broadcast(bits)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, texts in steps(batches):
            hashes, _, _, owner, _ = words(texts)
            bounds = np.searchsorted(owner, np.arange(len(texts) + 1))
            found = []
            for k in lengths:
                place, value = grams(hashes, owner, k)
                some = _passed(value, held.value, power)
                found.append((place[some], value[some]))
            place, value = (np.concatenate(x) for x in zip(*found))
            order = np.argsort(place, kind="stable")
            place, value = place[order], value[order]
            offsets = np.searchsorted(owner[place], np.arange(len(texts) + 1))
            some = np.flatnonzero(np.diff(offsets))
            ends = pa.array(np.append(offsets[some], len(place)), pa.int32())
            yield pa.RecordBatch.from_arrays([
                batch.column("doc_id").take(pa.array(some)), batch.column("text").take(pa.array(some)),
                pa.ListArray.from_arrays(ends, pa.array(value.view(np.int64))),
                pa.ListArray.from_arrays(ends, pa.array(place - bounds[owner[place]]))], names=["doc_id", "text", "value", "place"])

    found = map_arrow(rows, run, "doc_id long, text string, value array<long>, place array<long>")
    return written(found.withColumn("row", F.monotonically_increasing_id()), "license-runs")


def scan(docs: DataFrame, templates: DataFrame, min_coverage: float = MIN_COVERAGE,
         doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per match of a template (columns ``template_id``, ``text``) in a
    document: ``coverage``, ``matched_words``, ``template_words``, and ``start``
    and ``end`` of the span (code points, end exclusive).

    A template that occurs several times in a document, or in parts, gives a row
    for each span; ``coverage`` and ``matched_words`` are those of the span, while
    ``min_coverage`` holds for the words that all of them match.
    Templates of fewer than GRAM words match as a whole; texts without words
    (empty, null) never match.  Repeated rows are repeated.
    """
    spark = docs.sparkSession
    rows = docs.select(F.col(doc_id).cast("long").alias("doc_id"), text_col(text).alias("text"))
    table = index_templates(templates)
    entries = table.select("t_id", F.explode(F.arrays_zip("value", "place")).alias("e"))
    entries = entries.select("t_id", F.col("e.value").alias("value"), F.col("e.place").alias("t_place"))
    lengths = sorted(r[0] for r in table.where("t_n > 0").select(F.least("t_n", F.lit(GRAM))).distinct().collect())
    if not lengths:
        return spark.createDataFrame([], RESULT)
    n, n_words = entries.count(), table.agg(F.sum("t_n")).first()[0]
    bits, power = _filter(entries, n)
    runs_found = _looked_up(rows, bits, power, lengths)

    # Hits: the runs that are in the index, by document and template.
    hits = runs_found.select("row", F.explode(F.arrays_zip("value", "place")).alias("h"))
    hits = hits.select("row", F.col("h.value").alias("value"), F.col("h.place").alias("place"))
    hits = hits.join(F.broadcast(entries) if n <= BROADCAST_ROWS else entries, "value")
    hits = hits.groupBy("row", "t_id").agg(F.collect_list(F.struct("place", "t_place")).alias("hits"))
    wanted = table.select(F.col("t_id").alias("w_id"), "template_id", "t_words")
    hits = hits.join(F.broadcast(wanted) if n_words + table.count() <= BROADCAST_ROWS else wanted, F.col("t_id") == F.col("w_id"))
    # Each document's text, then its candidates.
    sides = runs_found.select("row", F.lit(-1).cast("long").alias("t_id"), "doc_id", "text").unionByName(
        hits.select("row", "t_id", F.col("hits.place").alias("place"), F.col("hits.t_place").alias("t_place"), "template_id", "t_words"),
        allowMissingColumns=True)
    sides = sides.repartition("row").sortWithinPartitions("row", "t_id")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own, doc = None, None
        for batch in batches:
            out = []
            some = (batch.column(c).to_pylist() for c in ("t_id", "doc_id", "text", "place", "t_place", "template_id", "t_words"))
            for t_id, d, content, place, t_place, template_id, t_words in zip(*some):
                if t_id < 0:
                    own, doc = d, (content, None)
                    continue
                if doc[1] is None:
                    doc = (doc[0], words([doc[0]])[:3])
                hashes, starts, stops = doc[1]
                template, place, t_place = np.frombuffer(t_words, "<u8"), np.array(place), np.array(t_place)
                order = np.lexsort((place - t_place, place))
                place, diagonal = place[order], (place - t_place)[order]
                found = spans(template, hashes, place, diagonal)
                if not found or len(np.unique(np.concatenate([x for x, _, _ in found]))) < min_coverage * len(template):
                    continue
                for matched, first, last in sorted(found, key=lambda x: (-len(x[0]), x[1])):
                    out.append((own, template_id, len(matched) / len(template), len(matched), len(template), int(starts[first]), int(stops[last])))
            columns = list(zip(*out)) or [()] * 7
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, TYPES)], names=NAMES)

    return map_arrow(sides.select("t_id", "doc_id", "text", "place", "t_place", "template_id", "t_words"), run, RESULT)
