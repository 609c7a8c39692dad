"""License scan: MinHash bands over overlapping text windows, then exact shingle containment.

Templates are grouped by their number of ``SHINGLE``-word shingles. For a group of up to T shingles, the
text's shingles are cut into blocks of ``step`` (a quarter of the group's smallest template) and a window
is the run of blocks that is sure to hold a whole occurrence wherever it starts. A window with a template
at containment c has a Jaccard similarity of at least c*t / (window + (1-c)*t); the group takes as many
bands of ``ROWS`` rows as make the chance of a shared band at that similarity at least ``LEAST_CHANCE``.
Where the similarity is sure to be 1 (templates so short that any missing shingle is too much), one row in
one band finds every case. Retrieved (window, template) pairs are verified by exact containment.

The templates are a parameter, a small fixed list; the texts are read once and nothing is shuffled.
"""

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame

from matchloom.llm.common import ALNUM, id_text, kept, map_batches, slices

SHINGLE, CONTAINMENT, ROWS, LEAST_CHANCE, WORD_CACHE = 5, 0.8, 2, 0.9998, 400_000

#: License notices and the opening or core passages of public licenses, by SPDX-like names.
TEMPLATES = {
    "Apache-2.0": "Licensed under the Apache License, Version 2.0.",
    "CC-BY-NC-4.0": "Licensed under CC BY-NC 4.0.",
    "GPL-3.0": "This work is licensed under the GNU General Public License, version 3.",
    "MIT": "Released under the MIT License.",
    "Apache-2.0-header": 'Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in compliance with the License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0 Unless required by applicable law or agreed to in writing, software distributed under the License is distributed on an "AS IS" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied. See the License for the specific language governing permissions and limitations under the License.',
    "MIT-permission": 'Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the "Software"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the following conditions: The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software.',
    "BSD-conditions": "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met: Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer. Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer in the documentation and/or other materials provided with the distribution.",
    "GPL-3.0-notice": "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version. This program is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; without even the implied warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE. See the GNU General Public License for more details.",
    "MPL-2.0-notice": "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was not distributed with this file, You can obtain one at http://mozilla.org/MPL/2.0/.",
    "ISC-permission": "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the above copyright notice and this permission notice appear in all copies.",
    "CC-BY-4.0": "This work is licensed under a Creative Commons Attribution 4.0 International License.",
    "CC-BY-SA-4.0": "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License.",
}
MIXED = np.uint64(0x9E3779B97F4A7C15)
_words: dict[bytes, bytes] = kept(__name__)


def mix(x: np.ndarray) -> np.ndarray:
    """A fixed 64-bit finaliser."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def word_hashes(text: bytes) -> np.ndarray:
    words = text.translate(ALNUM).split()
    if len(_words) > WORD_CACHE:
        _words.clear()
    found = list(map(_words.get, words))
    if None in found:
        for i, x in enumerate(found):
            if x is None:
                found[i] = _words[words[i]] = xxhash.xxh64_digest(words[i], 42)
    return np.frombuffer(b"".join(found), ">u8").astype(np.uint64)


def shingles(words: np.ndarray, n: int = SHINGLE) -> np.ndarray:
    """Hashes of all runs of ``n`` words, in order (fewer words: none)."""
    if len(words) < n:
        return np.zeros(0, np.uint64)
    h = np.zeros(len(words) - n + 1, np.uint64)
    for k in range(n):
        h = h * MIXED + words[k : len(words) - n + 1 + k]
    return mix(h)


@dataclass
class Group:
    """Templates of similar size, and the windows and bands that find them."""

    names: list[str]
    sets: list[np.ndarray]
    step: int
    blocks: int
    rows: int
    bands: int
    keys: list[np.ndarray] = None  # by band: sorted keys
    owner: list[np.ndarray] = None


def groups(templates: dict[str, str], containment: float = CONTAINMENT) -> list[Group]:
    """Templates of at least one shingle, in groups whose sizes differ by less than a quarter."""
    sized = sorted((len(s), name, s) for name, text in templates.items() if len(s := np.unique(shingles(word_hashes(text.encode())))))
    out: list[list[tuple[int, str, np.ndarray]]] = []
    for x in sized:
        if out and x[0] < 1.25 * out[-1][0][0]:
            out[-1].append(x)
        else:
            out.append([x])
    found = []
    for own in out:
        least, most = own[0][0], own[-1][0]
        step = max(1, least // 4)
        blocks = -(-(most + step - 1) // step)
        window = blocks * step
        lowest = min(math.ceil(containment * t) / (window + t - math.ceil(containment * t)) for t, _, _ in own)
        rows, bands = (1, 1) if lowest == 1 else (ROWS, math.ceil(math.log(1 - LEAST_CHANCE) / math.log(1 - lowest**ROWS)))
        g = Group([x[1] for x in own], [x[2] for x in own], step, blocks, rows, bands)
        signed = [band_keys([permuted(s, k).min(keepdims=True) for k in range(rows * bands)], rows) for s in g.sets]
        g.keys, g.owner = [], []
        for b in range(bands):
            keys = np.array([s[b][0] for s in signed])
            order = np.argsort(keys, kind="stable")
            g.keys.append(keys[order])
            g.owner.append(order)
        found.append(g)
    return found


def permuted(h: np.ndarray, k: int) -> np.ndarray:
    """The k-th hash of shingles, from their 64-bit hash; 32 bits."""
    a = np.uint64(xxhash.xxh64_intdigest(f"a{k}".encode()) | 1)
    b = np.uint64(xxhash.xxh64_intdigest(f"b{k}".encode()))
    return ((h * a + b) >> np.uint64(32)).astype(np.uint32)


def band_keys(minima: list[np.ndarray], rows: int) -> list[np.ndarray]:
    return [minima[i].astype(np.uint64) if rows == 1 else minima[i].astype(np.uint64) << np.uint64(32) | minima[i + 1] for i in range(0, len(minima), rows)]


def retrieve(h: np.ndarray, sizes: np.ndarray, all_groups: list[Group]) -> list[tuple[int, int, int]]:
    """(group, start, template) that share a band, for windows that begin at each block of each text of ``h``; blocks and windows end with their text."""
    begins = np.cumsum(sizes) - sizes
    cuts, texts = [], []
    for g in all_groups:
        n = -(-sizes // g.step)
        text = np.repeat(np.arange(len(sizes)), n)
        cuts.append(begins[text] + (np.arange(len(text)) - (np.cumsum(n) - n)[text]) * g.step)
        texts.append(text)
    held: list[np.ndarray | None] = [None] * len(all_groups)
    pairs: set[tuple[int, int, int]] = set()
    for k in range(max((g.rows * g.bands for g in all_groups), default=0)):
        p = permuted(h, k)
        for n, g in enumerate(all_groups):
            if k >= g.rows * g.bands:
                continue
            least = p if g.step == 1 else np.minimum.reduceat(p, cuts[n])
            low = least.copy()
            for j in range(1, min(g.blocks, len(low))):
                np.minimum(low[:-j], least[j:], out=low[:-j], where=texts[n][:-j] == texts[n][j:])
            if (k + 1) % g.rows:
                held[n] = low
                continue
            key = low.astype(np.uint64) if g.rows == 1 else held[n].astype(np.uint64) << np.uint64(32) | low
            keys = g.keys[k // g.rows]
            for i in np.unique(keys):
                for at in np.flatnonzero(key == i):
                    pairs.update((n, int(cuts[n][at]), int(t)) for t in g.owner[k // g.rows][keys == i])
    return sorted(pairs)


def scan(texts: list[bytes | None], found_groups: list[Group], containment: float = CONTAINMENT) -> list[list[dict]]:
    """Per text, the spans of words that hold a template, each with its name and containment."""
    hashed = [shingles(word_hashes(t)) if t else np.zeros(0, np.uint64) for t in texts]
    sizes = np.array([len(x) for x in hashed], np.int64)
    ends = np.cumsum(sizes)
    flat = np.concatenate(hashed) if hashed else np.zeros(0, np.uint64)
    out: list[list[dict]] = [[] for _ in texts]
    if not len(flat):
        return out
    raw: dict[tuple[int, str], list[list]] = {}
    for n, at, t in retrieve(flat, sizes, found_groups):
        g = found_groups[n]
        d = int(np.searchsorted(ends, at, side="right"))
        begin, window = int(ends[d] - sizes[d]), g.blocks * g.step
        for slack in (0, window):  # an occurrence with words put in reaches beyond the window
            low, high = max(at - slack, begin), min(at + window + slack, int(ends[d]))
            own = flat[low:high]
            hit = np.flatnonzero(np.isin(own, g.sets[t]))
            share = len(np.unique(own[hit])) / len(g.sets[t])
            if share >= containment:
                raw.setdefault((d, g.names[t]), []).append([low - begin + int(hit[0]), low - begin + int(hit[-1]) + SHINGLE, share])
                break
    for (d, name), spans in raw.items():
        joined: list[list] = []
        for a, b, share in sorted(spans):
            if joined and a < joined[-1][1]:
                joined[-1] = [joined[-1][0], max(b, joined[-1][1]), max(share, joined[-1][2])]
            else:
                joined.append([a, b, share])
        out[d] += [{"license": name, "start": a, "end": b, "containment": share} for a, b, share in joined]
    return [sorted(x, key=lambda s: (s["start"], s["end"], s["license"])) for x in out]


FOUND = pa.list_(pa.struct([("license", pa.string()), ("start", pa.int64()), ("end", pa.int64()), ("containment", pa.float64())]))


def license_spans(df: DataFrame, templates: dict[str, str] = TEMPLATES, containment: float = CONTAINMENT, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, n_words, spans) for every row of ``df``; spans: array of (license, start, end, containment), in words.

    Overlapping windows of one occurrence are one span; occurrences of several templates may overlap.
    Null and empty texts have no spans, texts of fewer than five words hold no template; very long texts
    are scanned whole; rows repeated under one id are rows of their own; an empty table gives an empty
    result; other columns are ignored.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = groups(templates, containment)
        for batch in batches:
            for ids, texts in slices(batch):
                found = scan(texts, own, containment)
                n = [len(t.translate(ALNUM).split()) if t else 0 for t in texts]
                yield pa.record_batch([ids, pa.array(n, pa.int64()), pa.array(found, FOUND)], ["id", "n_words", "spans"])

    return map_batches(id_text(df, id_col, text_col), run, "id long, n_words long, spans array<struct<license:string,start:long,end:long,containment:double>>")
