"""Licence scans: parts of a text compared with licence templates by the Dice coefficient over word bigrams.

A text is normalised to lower-case words of letters and digits. Its parts are the whole text, each paragraph and each line. A part matches
a template when 2 * |A & B| >= limit * (|A| + |B|) over their bigrams, each counted as often as it occurs. Bounds on size rule out most
parts and templates: with a share of at least the limit, the smaller has at least limit / (2 - limit) of the larger one's bigrams. Only parts
with enough places whose bigram hash is in some template are compared; the comparison itself is on the words.

Apart from matching parts, windows of words match as well: as long as a template, a quarter longer or half as long again (the largest a match can be),
and cut to begin and end with a bigram of the template. Only where places with a known bigram lie dense enough for some window are
windows compared, each in constant time from the one before. Of windows that overlap, the one of highest share counts, and none
that overlaps a matching part. The templates of ``scan`` are notices and whole licences.

Cases: null and empty texts, and parts of fewer than two words, match nothing. Repeated rows are scanned each. Only the text column is
read, whatever other columns are called. Long texts are read whole. An empty table gives an empty table.
"""

from __future__ import annotations

import pkgutil
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, functions as F, types as T

from ontime.llm import textblocks as B

#: Least Dice coefficient of a match.
LIMIT = 0.8

#: Names and wordings of public licences and of the notices by which texts refer to them.
TEMPLATES = {
    "Apache-2.0": "Licensed under the Apache License, Version 2.0.",
    "Apache-2.0 header": (
        'Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in compliance with the License. '
        "You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0 "
        "Unless required by applicable law or agreed to in writing, software distributed under the License is distributed on an "
        '"AS IS" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied. '
        "See the License for the specific language governing permissions and limitations under the License."
    ),
    "BSD": "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met:",
    "CC-BY": "This work is licensed under a Creative Commons Attribution 4.0 International License.",
    "CC-BY notice": "Licensed under CC BY 4.0.",
    "CC-BY-NC": "Licensed under CC BY-NC 4.0.",
    "CC-BY-SA": "Licensed under CC BY-SA 4.0.",
    "GPL-3.0": "This work is licensed under the GNU General Public License, version 3.",
    "GPL header": (
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published "
        "by the Free Software Foundation, either version 3 of the License, or (at your option) any later version."
    ),
    "ISC": (
        "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, "
        "provided that the above copyright notice and this permission notice appear in all copies."
    ),
    "MIT": "Released under the MIT License.",
    "MIT text": (
        'Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the "Software"), '
        "to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, "
        "sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the following conditions: "
        "The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software."
    ),
    "MPL-2.0": (
        "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was not distributed with this file, "
        "You can obtain one at http://mozilla.org/MPL/2.0/."
    ),
    "Unlicense": "This is free and unencumbered software released into the public domain.",
}

_AS_IS = (
    "THE SOFTWARE IS PROVIDED {0}, WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, "
    "FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER "
    "LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS "
    "IN THE SOFTWARE."
).format('"AS IS"')
_FILES = ("Apache-2.0", "CC0-1.0", "GPL-2", "GPL-3", "LGPL-2.1", "LGPL-3", "MPL-2.0")
#: Whole licences, beside the notices.
WHOLE = {
    "ISC whole": TEMPLATES["ISC"]
    + ' THE SOFTWARE IS PROVIDED "AS IS" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING ALL IMPLIED WARRANTIES OF '
    "MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL THE AUTHOR BE LIABLE FOR ANY SPECIAL, DIRECT, INDIRECT, OR CONSEQUENTIAL DAMAGES OR ANY DAMAGES "
    "WHATSOEVER RESULTING FROM LOSS OF USE, DATA OR PROFITS, WHETHER IN AN ACTION OF CONTRACT, NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING OUT OF OR "
    "IN CONNECTION WITH THE USE OR PERFORMANCE OF THIS SOFTWARE.",
    "MIT whole": TEMPLATES["MIT text"] + " " + _AS_IS,
    **{f"{name} whole": pkgutil.get_data(__name__, f"license_texts/{name}.txt").decode() for name in _FILES},
}

MATCH = T.StructType([T.StructField("license", T.StringType()), T.StructField("dice", T.DoubleType()), T.StructField("start", T.LongType()), T.StructField("end", T.LongType())])
_ARROW = pa.list_(pa.struct([("license", pa.string()), ("dice", pa.float64()), ("start", pa.int64()), ("end", pa.int64())]))

_NOT_WORD = np.ones(256, bool)
_NOT_WORD[[*range(ord("0"), ord("9") + 1), *range(ord("a"), ord("z") + 1), *range(128, 256)]] = False


def _plain(data: np.ndarray) -> np.ndarray:
    """Lower case, with a space for every byte that is no letter or digit."""
    low = B.lowered(data)
    return np.where(_NOT_WORD[low], 32, low).astype(np.uint8)


def words(text: str) -> list[bytes]:
    return _plain(np.frombuffer(text.encode(), np.uint8)).tobytes().split()


def bigrams(found: list[bytes]) -> Counter[tuple[bytes, bytes]]:
    return Counter(zip(found, found[1:]))


class Templates:
    """Bigrams of each template, by their number, and the hashes of all of them."""

    def __init__(self, texts: dict[str, str], limit: float):
        self.limit = limit
        self.sets = sorted(((k, bigrams(words(v))) for k, v in texts.items()), key=lambda t: (t[1].total(), t[0]))
        self.sizes = np.array([s.total() for _, s in self.sets], np.int64)
        every = sorted({b for _, s in self.sets for b in s})
        joined = "\n".join(b" ".join(b).decode() for b in every)
        block = next(B.blocks(pa.array([joined])), None)
        self.hashes = np.zeros(0, np.uint64)
        if block is not None:
            start, end, _ = block.words()
            self.hashes = np.sort(B.Rolling(block.hashes().of(start, end)).of(np.arange(0, len(start), 2), np.arange(2, len(start) + 1, 2)))

    def of_size(self, n: int) -> slice:
        """Templates whose size lets a part of n bigrams match."""
        low = np.searchsorted(self.sizes, np.ceil(n * self.limit / (2 - self.limit) - 1e-9))
        return slice(int(low), int(np.searchsorted(self.sizes, np.floor(n * (2 - self.limit) / self.limit + 1e-9), side="right")))

    def best(self, part: Counter, n: int) -> tuple[str, float] | None:
        """The template of highest share, the first by name if equal."""
        shares = [(2 * (part & known).total() / (n + known.total()), name) for name, known in self.sets[self.of_size(n)]]
        found = min(((-share, name) for share, name in shares if share >= self.limit), default=None)
        return found and (found[1], -found[0])


def _parts(raw: bytes) -> list[tuple[int, int]]:
    """Bounds of the whole, the paragraphs and the lines, each once."""
    lines, at = [], 0
    for line in raw.split(b"\n"):
        lines.append((at, at + len(line)))
        at += len(line) + 1
    out = dict.fromkeys([(0, len(raw))])
    begin = None
    for a, b in [*lines, (len(raw), len(raw))]:
        if raw[a:b].strip():
            begin = a if begin is None else begin
            end = b
        elif begin is not None:
            out[(begin, end)] = None
            begin = None
    out.update(dict.fromkeys(x for x in lines if x[0] < x[1]))
    return list(out)


def _hits(plain: B.Block, templates: Templates) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Bounds and row of each word; the words that begin a bigram, and whether some template has it, by hash."""
    start, end, row = plain.words()
    pairs = np.flatnonzero(row[1:] == row[:-1])
    value = B.Rolling(plain.hashes().of(start, end)).of(pairs, pairs + 2)
    at = np.searchsorted(templates.hashes, value)
    at[at == len(templates.hashes)] = 0
    known = templates.hashes[at] == value if len(templates.hashes) else np.zeros(len(pairs), bool)
    return start, end, row, pairs, known


def _scan_block(block: B.Block, templates: Templates) -> list[list[dict]]:
    plain = B.Block(block.first, _plain(block.data), block.bounds)
    start, _, _, pairs, known = _hits(plain, templates)
    hits = start[pairs[known]]
    out: list[list[dict]] = [[] for _ in range(block.rows)]
    for i in np.unique(block.row_of(hits)).tolist():
        low, high = block.bounds[i], block.bounds[i + 1]
        mine = hits[np.searchsorted(hits, low) : np.searchsorted(hits, high)] - low
        begins = start[np.searchsorted(start, low) : np.searchsorted(start, high)] - low
        raw, flat = block.data[low:high].tobytes(), plain.data[low:high].tobytes()
        for a, b in _parts(raw):
            # Bounds first: the part's size, and the number of its places with a known bigram.
            n = int(np.searchsorted(begins, b) - np.searchsorted(begins, a)) - 1
            sizes = templates.sizes[templates.of_size(n)] if n > 0 else templates.sizes[:0]
            known = int(np.searchsorted(mine, b) - np.searchsorted(mine, a))
            if not len(sizes) or 2 * known < templates.limit * (n + sizes[0]):
                continue
            found = templates.best(bigrams(flat[a:b].split()), n)
            if found:
                begin, until = len(raw[:a].decode()), len(raw[:b].decode())
                out[i].append({"license": found[0], "dice": found[1], "start": begin, "end": until})
    return out


def _lengths(size: int, limit: float) -> list[int]:
    return sorted({size, size * 5 // 4, int(size * (2 - limit) / limit + 1e-9)})


def _slide(mine: list[tuple], begins: range, length: int, template: Counter, limit: float) -> Iterator[tuple[float, int, int]]:
    """(share, first, last) of windows of bigrams that match: those of one length at each place to begin, cut to known ends."""
    size, held, common = template.total(), Counter(), 0
    until, last, low = begins.start, -1, begins.start
    for i in begins:
        for gone in mine[low:i]:
            common -= held[gone] <= template[gone]
            held[gone] -= 1
        low = i
        while until < min(i + length, len(mine)):
            pair = mine[until]
            held[pair] += 1
            if pair in template:
                last = until
                common += held[pair] <= template[pair]
            until += 1
        share = 2 * common / (last - i + 1 + size) if last >= i else 0
        if share >= limit and mine[i] in template:
            yield share, i, last


def _windows(block: B.Block, templates: Templates, parts: list[list[dict]]) -> list[list[dict]]:
    """The matches of parts, and with them those of windows that overlap none of these."""
    plain = B.Block(block.first, _plain(block.data), block.bounds)
    start, end, row, pairs, known = _hits(plain, templates)
    if not known.any():
        return parts
    total = np.concatenate(([0], np.cumsum(known)))
    owner = row[pairs]
    first_of = np.searchsorted(owner, np.arange(block.rows + 1))
    places = np.flatnonzero(known)
    stop = first_of[owner[places] + 1]
    flat = plain.data.tobytes()
    found: dict[int, list[tuple]] = {}
    bigrams_of: dict[int, list[tuple]] = {}
    for (name, template), size in zip(templates.sets, templates.sizes.tolist()):
        # No window can match with fewer known places than this.
        least = int(np.ceil(size * templates.limit / (2 - templates.limit) - 1e-9))
        for length in _lengths(size, templates.limit) if size else []:
            dense = places[total[np.minimum(places + length, stop)] - total[places] >= max(least, 1)]
            if not len(dense):
                continue
            # Runs of places to begin, apart by more than a window or in different rows.
            cut = np.flatnonzero((np.diff(dense) > length) | (np.diff(owner[dense]) > 0)) + 1
            for run in np.split(dense, cut):
                r = int(owner[run[0]])
                base = int(first_of[r])
                if r not in bigrams_of:
                    ws = [flat[start[k] : end[k]] for k in range(pairs[base], pairs[first_of[r + 1] - 1] + 2)]
                    bigrams_of[r] = list(zip(ws, ws[1:]))
                begins = range(int(run[0]) - base, int(run[-1]) - base + 1)
                for share, i, last in _slide(bigrams_of[r], begins, length, template, templates.limit):
                    found.setdefault(r, []).append((-share, name, int(pairs[base + i]), int(pairs[base + last]) + 1))
    out = list(parts)
    for r, windows in found.items():
        low = block.bounds[r]
        raw = block.data[low : block.bounds[r + 1]].tobytes()
        chars = np.concatenate(([0], np.cumsum((np.frombuffer(raw, np.uint8) & 0xC0) != 0x80)))
        taken = np.zeros(int(chars[-1]), bool)
        for m in parts[r]:
            taken[m["start"] : m["end"]] = True
        out[r] = list(parts[r])
        for share, name, i, last in sorted(windows):
            a, b = int(chars[start[i] - low]), int(chars[end[last] - low])
            if not taken[a:b].any():
                taken[a:b] = True
                out[r].append({"license": name, "dice": -share, "start": a, "end": b})
    return out


def scan(text: str | Column, templates: dict[str, str] = TEMPLATES | WHOLE, limit: float = LIMIT) -> Column:
    """All matching parts and windows of each text: licence, coefficient, and the bounds in code points."""
    known = Templates(templates, limit)

    def scanned(texts: pa.Array) -> pa.Array:
        return pa.array([m for block in B.blocks(texts) for m in _windows(block, known, _scan_block(block, known))], _ARROW)

    return F.arrow_udf(scanned, T.ArrayType(MATCH)).asNondeterministic()(text)
