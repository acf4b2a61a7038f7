"""License scans: MinHash bands over overlapping windows, verified by shingle containment.

Texts and templates are compared as bare words (letters and digits, lower case)
in shingles of ``K`` words. A template of n shingles belongs to the window size
W, the largest power of two that an occurrence must hold a whole document window
of (n >= W + W/4 - 1, windows lie W/4 apart). All of the template's own windows
of that size are indexed, so an unchanged occurrence has a window that collides
in every band, and one of similarity s to some template window collides with
probability 1 - (1 - s**ROWS)**BANDS: 0.99 at s = 0.67, which a contained share
of 0.8 leaves to the best aligned window, and an occurrence holds four windows
or more.

Retrieved templates are verified exactly in the region around the window (one
template length to both sides): an occurrence must hold a share of ``threshold``
of the template's shingles. Occurrences of a template do not overlap.

Minima of windows come from sliding minima by doubling, so a document costs the
same for any number of templates. The index has a few entries per template word
and is held by every task; it is bounded by the given templates, whose words are
limited to ``MAX_WORDS``.

Defined cases: null and blank texts and templates match nothing; repeated rows
are scanned each; extra columns are ignored.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kinstar.llm.near_dup import _family
from kinstar.llm.words import BARE, blocks, mix64, window_hashes

K = 3
ROWS, BANDS = 2, 8
#: Words of all templates together at most (a task holds about 100 bytes for each).
MAX_WORDS = 1_000_000

# fixed values: notices by which licenses are commonly stated
TEMPLATES = {
    "MIT": ["Released under the MIT License.",
            "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and "
            "associated documentation files (the \"Software\"), to deal in the Software without restriction, "
            "including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, "
            "and/or sell copies of the Software"],
    "Apache-2.0": ["Licensed under the Apache License, Version 2.0."],
    "GPL-3.0": ["This work is licensed under the GNU General Public License, version 3.",
                "This program is free software: you can redistribute it and/or modify it under the terms of the GNU "
                "General Public License as published by the Free Software Foundation, either version 3 of the "
                "License, or (at your option) any later version."],
    "CC-BY-NC-4.0": ["Licensed under CC BY-NC 4.0.",
                     "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License."],
    "CC-BY-4.0": ["This work is licensed under a Creative Commons Attribution 4.0 International License."],
    "BSD": ["Redistribution and use in source and binary forms, with or without modification, are permitted provided "
            "that the following conditions are met"],
    "MPL-2.0": ["This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0."],
}


def _shingles(text: str) -> np.ndarray:
    for _, _, words in blocks(pa.array([text]), lower=True, space=BARE):
        return window_hashes(words.hashes, K)
    return np.zeros(0, dtype=np.uint64)


def window_size(shingles: int) -> int:
    size = 1
    while 2 * size + max(1, 2 * size // 4) - 1 <= shingles:
        size *= 2
    return size


def sliding_minima(hashes: np.ndarray, size: int, have: int = 1) -> np.ndarray:
    """Minima of all runs of ``size`` along the last axis, from those of ``have`` (powers of two)."""
    while have < size:
        hashes = np.minimum(hashes[..., :-have], hashes[..., have:])
        have *= 2
    return hashes


def _keys(minima: np.ndarray, size: int) -> np.ndarray:
    """Band keys (bands by windows) of minima (hashes by windows)."""
    salt = mix64(np.arange(1, BANDS + 1, dtype=np.uint64) * np.uint64(1_000_003) + np.uint64(size))
    key = np.repeat(salt[:, None], minima.shape[1], axis=1)
    for r in range(ROWS):
        key = mix64(key ^ minima[r::ROWS])
    return key


class Index:
    """Band keys of all template windows by window size."""

    def __init__(self, templates: dict[str, list[str]]):
        listed = [(name, _shingles(text)) for name, texts in sorted(templates.items()) for text in texts]
        listed = [(name, s) for name, s in listed if len(s)]
        if sum(len(s) for _, s in listed) > MAX_WORDS:
            raise ValueError("too many template words; scan with parts of the templates")
        self.names = [name for name, _ in listed]
        self.lengths = np.array([len(s) for _, s in listed], dtype=np.int64)
        self.sets = [np.unique(s) for _, s in listed]
        self.a, self.b = _family(ROWS * BANDS)
        by_size: dict[int, list[tuple[np.ndarray, int]]] = {}
        for t, (_, s) in enumerate(listed):
            size = window_size(len(s))
            by_size.setdefault(size, []).append((_keys(sliding_minima(self.hashed(s), size), size).ravel(), t))
        self.keys = {}
        for size, parts in by_size.items():
            keys = np.concatenate([k for k, _ in parts])
            owner = np.repeat([t for _, t in parts], [len(k) for k, _ in parts])
            order = np.argsort(keys, kind="stable")
            self.keys[size] = keys[order], owner[order]

    def hashed(self, shingles: np.ndarray) -> np.ndarray:
        low = (shingles >> np.uint64(32)).astype(np.uint32)
        return low[None, :] * self.a[:, None] + self.b[:, None]

    def retrieved(self, shingles: np.ndarray) -> set[tuple[int, int]]:
        """(window start, template) of the windows that collide with a template in some band."""
        out: set[tuple[int, int]] = set()
        minima, have = self.hashed(shingles), 1
        for size in sorted(self.keys):
            if minima.shape[1] < size - have + 1:
                break
            minima, have = sliding_minima(minima, size, have), size
            step = max(1, size // 4)
            keys = _keys(minima[:, ::step], size)
            held, owner = self.keys[size]
            lo, hi = np.searchsorted(held, keys, "left"), np.searchsorted(held, keys, "right")
            for band, window in zip(*np.nonzero(hi > lo)):
                for t in set(owner[lo[band, window]:hi[band, window]].tolist()):
                    out.add((int(window) * step, t))
        return out

    def matches(self, shingles: np.ndarray, threshold: float) -> list[tuple[int, float, int, int]]:
        """(template, containment, first word, end word) of verified matches in one document."""
        regions: dict[int, list[list[int]]] = {}
        for start, t in sorted(self.retrieved(shingles)):
            n, own = int(self.lengths[t]), regions.setdefault(t, [])
            if own and start - n <= own[-1][1]:
                own[-1][1] = start + 2 * n
            else:
                own.append([max(0, start - n), start + 2 * n])
        return [(t, *m) for t, own in sorted(regions.items()) for lo, hi in own
                for m in self.verified(shingles[lo:hi], t, lo, threshold)]

    def verified(self, near: np.ndarray, t: int, lo: int, threshold: float) -> list[tuple[float, int, int]]:
        """(containment, first word, end word) of the template's occurrences in a region.

        An occurrence begins at one of its shingles, takes in at most a quarter
        more than the template's length, and ends with the last shingle that was
        not there before; of overlapping ones the best, then the shortest counts.
        """
        held = self.sets[t]
        at = np.flatnonzero(np.isin(near, held))
        reach = int(np.ceil(1.25 * self.lengths[t]))
        found = []
        for i, a in enumerate(at):
            part = at[i:np.searchsorted(at, a + reach)]
            kinds, first = np.unique(near[part], return_index=True)
            if len(kinds) >= threshold * len(held):
                found.append((len(kinds) / len(held), lo + int(a), lo + int(part[first.max()]) + K))
        chosen: list[tuple[float, int, int]] = []
        for share, a, b in sorted(found, key=lambda m: (-m[0], m[2] - m[1], m[1])):
            if all(b <= c or d <= a for _, c, d in chosen):
                chosen.append((share, a, b))
        return sorted(chosen, key=lambda m: m[1])


_FOUND = "license string, containment double, first_word long, end_word long, start long, `end` long"


def licenses(docs: DataFrame, templates: dict[str, list[str]] | None = None, id_col: str = "doc_id",
             text_col: str = "text", threshold: float = 0.8) -> DataFrame:
    """One row per verified occurrence: id, license, containment, its words (bare
    words of the text, end exclusive) and its place in code points."""
    index = Index(TEMPLATES if templates is None else templates)

    def run(batches):
        for batch in batches:
            out: list[list] = [[] for _ in range(7)]
            for row, end, words in blocks(batch.column(1), lower=True, space=BARE):
                all_shingles = window_hashes(words.hashes, K)
                for d in range(end - row):
                    a, b = int(words.first[d]), int(words.first[d + 1])
                    if b - a < K:
                        continue
                    best: dict[tuple[str, int, int], float] = {}
                    for t, share, first, last in index.matches(all_shingles[a:b - K + 1], threshold):
                        place = (index.names[t], first, last)
                        best[place] = max(best.get(place, 0.0), share)
                    if best:
                        # characters before a byte: bytes that do not continue one
                        text = words.data[words.offsets[d]:words.offsets[d + 1]]
                        chars = np.concatenate([[0], np.cumsum((text & 0xC0) != 0x80)])
                    for (name, first, last), share in sorted(best.items()):
                        s = int(chars[words.starts[a + first] - words.offsets[d]])
                        e = int(chars[words.ends[a + last - 1] - words.offsets[d]])
                        for column, value in zip(out, (batch.column(0)[row + d].as_py(), name, share, first, last, s, e)):
                            column.append(value)
            kinds = [pa.int64(), pa.string(), pa.float64(), *[pa.int64()] * 4]
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(out, kinds)],
                                             names=["doc_id", "license", "containment", "first_word", "end_word", "start", "end"])

    return docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string")).mapInArrow(
        run, "doc_id long, " + _FOUND)
