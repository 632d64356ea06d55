"""License notices in documents: MinHash bands over overlapping windows,
verified by exact shingle containment.

Templates are grouped by the size of their shingle set (up to 1, 2, 4, 8 ...
shingles).  For a group of up to s, windows of s shingles and a quarter more
start every s / 4 shingles, so a notice lies whole inside one window; the
worst similarity of that window with a template of the group, of which the
document holds the required share, follows from the sizes alone.  The number
of bands (one minimum hash each) is then chosen so that some band collides
with a probability of at least CERTAINTY.  What the bands retrieve is
verified: the share of the template's shingles that the document holds.

The templates are the fixed list below or a table of at most
MAX_TEMPLATE_SHINGLES shingles; that bound makes them fit every task, so the
scan is one pass over the documents without a shuffle.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strata.llm.decontaminate import permutations
from strata.llm.words import LOWER, Words, _words, buffers, mix
from strata.session import ship

SHINGLE = 5
PERCENT = 80
CERTAINTY = 0.99999
MAX_TEMPLATE_SHINGLES = 1_000_000
CHUNK = 2 << 20

# Notices of public licenses, by SPDX identifier.
TEMPLATES = [
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0."),
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in "
                   "compliance with the License. You may obtain a copy of the License at "
                   "http://www.apache.org/licenses/LICENSE-2.0"),
    ("MIT", "Released under the MIT License."),
    ("MIT", "Licensed under the MIT License."),
    ("MIT", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated "
            "documentation files (the \"Software\"), to deal in the Software without restriction, including without "
            "limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the "
            "Software"),
    ("GPL-3.0", "This work is licensed under the GNU General Public License, version 3."),
    ("GPL-3.0-or-later", "This program is free software: you can redistribute it and/or modify it under the terms of the GNU "
                         "General Public License as published by the Free Software Foundation, either version 3 of the "
                         "License, or (at your option) any later version."),
    ("CC-BY-NC-4.0", "Licensed under CC BY-NC 4.0."),
    ("CC-BY-4.0", "Licensed under CC BY 4.0."),
    ("CC-BY-SA-4.0", "Licensed under CC BY-SA 4.0."),
    ("CC-BY-4.0", "This work is licensed under a Creative Commons Attribution 4.0 International License."),
    # the beginning that BSD licenses share names the family, the third clause the license
    ("BSD", "Redistribution and use in source and binary forms, with or without modification, are permitted provided "
            "that the following conditions are met"),
    ("BSD-3-Clause", "Neither the name of the copyright holder nor the names of its contributors may be used to endorse or "
                     "promote products derived from this software without specific prior written permission."),
    ("ISC", "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby "
            "granted, provided that the above copyright notice and this permission notice appear in all copies."),
    ("Unlicense", "This is free and unencumbered software released into the public domain. Anyone is free to copy, modify, "
                  "publish, use, compile, sell, or distribute this software, either in source code form or as a compiled "
                  "binary, for any purpose, commercial or non-commercial, and by any means."),
    ("CC0-1.0", "To the extent possible under law, the author(s) have dedicated all copyright and related and neighboring "
                "rights to this software to the public domain worldwide. This software is distributed without any warranty."),
    ("MPL-2.0", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0."),
]

# punctuation separates words here: notices differ in it
FOLD = LOWER.copy()
FOLD[[*range(33, 48), *range(58, 65), *range(91, 97), *range(123, 127)]] = 0x20


def folded_chunks(column: pa.Array) -> Iterator[Words]:
    data, offsets = buffers(column)
    low, n = 0, len(offsets) - 1
    while low < n:
        high = min(n, max(low + 1, int(np.searchsorted(offsets, offsets[low] + CHUNK, "right")) - 1))
        yield _words(FOLD[data[offsets[low]:offsets[high]]], offsets[low:high + 1] - offsets[low], low)
        low = high


def needed(n: int, percent: int) -> int:
    return -(-percent * n // 100)


def windows_of(size: int) -> tuple[int, int]:
    """Block length and blocks in a window for templates of up to ``size`` shingles."""
    block = max(1, size // 4)
    return block, 1 if size == 1 else size // block + 1


def bands_for(sizes: list[int], size: int, percent: int) -> int:
    """Bands that collide with CERTAINTY for every template size of the group."""
    block, count = windows_of(size)
    worst = min(needed(n, percent) / (block * count + n - needed(n, percent)) for n in sizes)
    return 1 if worst >= 1 else int(np.ceil(np.log(1 - CERTAINTY) / np.log(1 - worst)))


def band_key(minimum: np.ndarray, band: int, size: int) -> np.ndarray:
    return mix(minimum.astype(np.uint64) | np.uint64((band << 24 | size) << 32))


def permuted(s: np.ndarray, band: int) -> np.ndarray:
    a, c = permutations()
    r = np.uint32(band % len(a))
    return (s >> np.uint64(band // len(a))).astype(np.uint32) * a[r] + c[r]


class Templates:
    """Shingles and band keys of the templates."""

    def __init__(self, rows: list[tuple[str, str]], percent: int):
        self.names, self.percent, self.sets = [], percent, []
        for name, text in rows:
            for w in folded_chunks(pa.array([text], pa.string())):
                s, _ = w.shingles(w.hashes(), SHINGLE)
                if len(s):
                    self.names.append(name)
                    self.sets.append(np.unique(s))
        if sum(map(len, self.sets)) > MAX_TEMPLATE_SHINGLES:
            raise ValueError("the templates have more shingles than a task should hold")
        groups: dict[int, list[int]] = {}
        for i, s in enumerate(self.sets):
            groups.setdefault(1 << int(np.ceil(np.log2(len(s)))), []).append(i)
        self.groups = {size: bands_for([len(self.sets[i]) for i in own], size, percent) for size, own in groups.items()}
        pairs = [(int(band_key(permuted(self.sets[i], b).min(keepdims=True), b, size)[0]), i)
                 for size, own in groups.items() for i in own for b in range(self.groups[size])]
        self.keys = np.array([k for k, _ in sorted(pairs)], np.uint64)
        self.template = np.array([i for _, i in sorted(pairs)], np.int64)
        self.hit = np.zeros(1 << 20, bool)
        self.hit[(self.keys & np.uint64((1 << 20) - 1)).astype(np.int64)] = True

    def retrieved(self, s: np.ndarray, owner: np.ndarray) -> set[tuple[int, int]]:
        """(text, template) pairs that a band of some window retrieves."""
        found: set[tuple[int, int]] = set()
        first = np.concatenate([[0], np.flatnonzero(np.diff(owner)) + 1])
        size = np.diff(np.concatenate([first, [len(owner)]]))
        for group, bands in self.groups.items():
            block, count = windows_of(group)
            blocks = (size + block - 1) // block
            begin = np.repeat(first, blocks) + (np.arange(blocks.sum()) - np.repeat(np.cumsum(blocks) - blocks, blocks)) * block
            own = owner[begin]
            for b in range(bands):
                value = permuted(s, b)
                least = value if block == 1 else np.minimum.reduceat(value, begin)
                wide = least.copy()
                for k in range(1, count):
                    wide[:-k] = np.where(own[:-k] == own[k:], np.minimum(wide[:-k], least[k:]), wide[:-k])
                key = band_key(wide, b, group)
                at = np.flatnonzero(self.hit[(key & np.uint64((1 << 20) - 1)).astype(np.int64)])
                for lo, hi, text in zip(np.searchsorted(self.keys, key[at]), np.searchsorted(self.keys, key[at], "right"), own[at].tolist()):
                    found.update((text, int(t)) for t in self.template[lo:hi])
        return found


MATCHES = pa.list_(pa.struct([("license", pa.string()), ("containment", pa.float64()), ("start_byte", pa.int64()), ("end_byte", pa.int64())]))


def scan_licenses(df: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                  templates: list[tuple[str, str]] | None = None, percent: int = PERCENT) -> DataFrame:
    """(id, licenses, matches), one row per input row.

    ``licenses`` are the distinct names, in order, of templates of whose
    shingles (five words, ASCII case and punctuation ignored; a shorter
    template's whole text) the document holds percent / 100 or more;
    ``matches`` gives each such template's share and the byte range from its
    first to its last shingle found.  Null and empty texts have none; ids
    may be null or repeat; other columns are not read.
    """
    ship(df.sparkSession)
    rows = templates if templates is not None else TEMPLATES
    shared = df.sparkSession.sparkContext.broadcast(Templates(rows, percent))

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = shared.value
        for b in batches:
            matches: list[list[dict]] = [[] for _ in range(b.num_rows)]
            for w in folded_chunks(b.column(1)) if known.sets else ():
                h = w.hashes()
                s, owner = w.shingles(h, SHINGLE)
                if not len(s):
                    continue
                first = np.searchsorted(owner, np.arange(len(w.counts) + 1))
                for text, t in sorted(known.retrieved(s, owner)):
                    own = s[first[text]:first[text + 1]]
                    at = np.flatnonzero(np.isin(own, known.sets[t]))
                    held = len(np.unique(own[at]))
                    if 100 * held >= percent * len(known.sets[t]):
                        low, last = w.first[text] + at[0], min(w.first[text] + at[-1] + SHINGLE, w.first[text + 1]) - 1
                        matches[w.low + text].append({"license": known.names[t], "containment": held / len(known.sets[t]),
                                                      "start_byte": int(w.start[low] - w.base[text]), "end_byte": int(w.end[last] - w.base[text])})
            yield pa.RecordBatch.from_arrays(
                [b.column(0), pa.array([sorted({m["license"] for m in x}) for x in matches], pa.list_(pa.string())), pa.array(matches, MATCHES)],
                ["id", "licenses", "matches"])

    kind = df.schema[id_col].dataType.simpleString()
    return (df.select(F.col(f"`{id_col}`").alias("id"), F.col(f"`{text_col}`").alias("text"))
            .mapInArrow(scan, f"id {kind}, licenses array<string>, matches array<struct<license:string,containment:double,start_byte:long,end_byte:long>>")
            .withColumnRenamed("id", id_col))
