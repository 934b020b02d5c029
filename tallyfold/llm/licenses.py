"""License scans by patience alignment.

A text is laid against a license text in windows of twice the license's words, half a license apart,
so that a notice stands whole in one of them. Inside a window the words that occur once in both are
anchors; the longest run of anchors in the same order on both sides is kept, and the gaps between
them are aligned in the same way, with what becomes unique there. Where a gap has no anchor, equal words at its two ends
are matched. Coverage is the share of the license's words that are matched.

Only windows with enough words of the license to reach the least coverage are aligned; that many are
needed, so none is missed. Every text is scanned whole.

Defined cases: null and empty texts hold no license; a license without words is never found. Of
several windows of one license the best coverage counts, then the first. Of several licenses the best is that of
most coverage, then of most words, then of the smaller id. Rows are scanned each, repeated or not.
"""

from __future__ import annotations

from bisect import bisect_left
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from tallyfold.llm.frames import room_for
from tallyfold.llm.words import hashed_words, slices, text_buffers

#: Share of a license's words that a text must hold in order.
LEAST = 0.8
AT_ONCE = 4 << 20
FOUND = "array<struct<license_id: string, coverage: double, words: int, start: bigint, stop: bigint>>"

#: Notices by the name of their license.
NOTICES = (
    ("MIT", "Released under the MIT License."),
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0."),
    ("GPL-3.0", "This work is licensed under the GNU General Public License, version 3."),
    ("CC-BY-NC-4.0", "Licensed under CC BY-NC 4.0."),
    ("CC-BY-4.0", "This work is licensed under a Creative Commons Attribution 4.0 International License."),
    ("MIT-text", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software "
     "and associated documentation files, to deal in the Software without restriction, including without "
     "limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies "
     "of the Software, and to permit persons to whom the Software is furnished to do so"),
    ("Apache-2.0-header", "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this "
     "file except in compliance with the License. You may obtain a copy of the License at"),
    ("BSD", "Redistribution and use in source and binary forms, with or without modification, are permitted "
     "provided that the following conditions are met"),
)


def longest_rising(values: list[int]) -> list[int]:
    """Places of a longest rising subsequence, by patience sorting."""
    tops: list[int] = []
    piles: list[int] = []
    below = [-1] * len(values)
    for i, value in enumerate(values):
        pile = bisect_left(tops, value)
        below[i] = piles[pile - 1] if pile else -1
        if pile == len(tops):
            tops.append(value)
            piles.append(i)
        else:
            tops[pile], piles[pile] = value, i
    out = []
    at = piles[-1] if piles else -1
    while at >= 0:
        out.append(at)
        at = below[at]
    return out[::-1]


def aligned(license_: list[int], text: list[int]) -> list[tuple[int, int]]:
    """Pairs of places of equal words, rising on both sides."""
    pairs: list[tuple[int, int]] = []
    gaps = [(0, len(license_), 0, len(text))]
    while gaps:
        i, j, k, n = gaps.pop()
        if i == j or k == n:
            continue
        ours, theirs = Counter(license_[i:j]), Counter(text[k:n])
        once = {word: k + at for at, word in enumerate(text[k:n]) if theirs[word] == 1}
        anchors = [(at, once[w]) for at, w in enumerate(license_[i:j], i) if ours[w] == 1 and w in once]
        if anchors:
            kept = [anchors[at] for at in longest_rising([t for _, t in anchors])]
            pairs += kept
            edges = [(i - 1, k - 1), *kept, (j, n)]
            gaps += [(a + 1, c, b + 1, d) for (a, b), (c, d) in zip(edges, edges[1:], strict=False)]
            continue
        while i < j and k < n and license_[i] == text[k]:
            pairs.append((i, k))
            i, k = i + 1, k + 1
        while i < j and k < n and license_[j - 1] == text[n - 1]:
            j, n = j - 1, n - 1
            pairs.append((j, n))
    return sorted(pairs)


class Licenses:
    """License texts as numbers for their words."""

    def __init__(self, licenses: list[tuple[str, str]]) -> None:
        data, offsets = text_buffers(pa.array([t for _, t in licenses], pa.string()))
        hashes, _, _, bounds = hashed_words(data, offsets)
        self.vocabulary, numbers = np.unique(hashes, return_inverse=True)
        self.texts = [
            (name, numbers[i:j]) for (name, _), i, j in zip(licenses, bounds[:-1], bounds[1:], strict=True) if j > i]

    def numbered(self, hashes: np.ndarray) -> np.ndarray:
        """The number of each word, that of an unknown word being the last."""
        if not len(self.vocabulary):
            return np.zeros(len(hashes), np.int64)
        at = np.minimum(np.searchsorted(self.vocabulary, hashes), len(self.vocabulary) - 1)
        return np.where(self.vocabulary[at] == hashes, at, len(self.vocabulary))

    def scan(self, hashes: np.ndarray, bounds: np.ndarray, least: float = LEAST) -> Iterator[tuple]:
        """Text, license, coverage, words matched, first word and the word after the last."""
        words = self.numbered(hashes)
        sizes = np.diff(bounds)
        for name, license_ in self.texts:
            size = len(license_)
            step, need = max(1, size // 2), int(np.ceil(least * size))
            known = np.zeros(len(self.vocabulary) + 1, bool)
            known[license_] = True
            upto = np.concatenate(([0], np.cumsum(known[words])))
            counts = np.where(sizes > 0, (sizes + step - 1) // step, 0)
            doc = np.repeat(np.arange(len(sizes)), counts)
            start = bounds[doc] + (np.arange(len(doc)) - (np.cumsum(counts) - counts)[doc]) * step
            stop = np.minimum(start + 2 * size, bounds[doc + 1])
            likely = upto[stop] - upto[start] >= need
            best: dict[int, tuple] = {}
            ours = license_.tolist()
            for d, a, b in zip(doc[likely].tolist(), start[likely].tolist(), stop[likely].tolist(), strict=True):
                pairs = aligned(ours, words[a:b].tolist())
                if len(pairs) >= need and (d not in best or len(pairs) > best[d][3]):
                    base = a - int(bounds[d])
                    best[d] = (d, name, len(pairs) / size, len(pairs), base + pairs[0][1], base + pairs[-1][1] + 1)
            yield from best.values()


def scanned(
    docs: DataFrame, licenses: list[tuple[str, str]] = list(NOTICES), text: str = "text", least: float = LEAST
) -> DataFrame:
    """Adds ``licenses``: those found in each text with coverage, words and place, the best first.

    Places are words of the text, counted from 0. The list of licenses goes to every task; a set of licenses
    is small by nature (some hundred texts).
    """
    shared = docs.sparkSession.sparkContext.broadcast(licenses)
    kept, schema = room_for(docs, f"licenses {FOUND}")
    kind = pa.struct([
        ("license_id", pa.string()), ("coverage", pa.float64()), ("words", pa.int32()),
        ("start", pa.int64()), ("stop", pa.int64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = Licenses(shared.value)
        for batch in batches:
            column = batch.column(batch.schema.get_field_index(text))
            for part in slices(column, AT_ONCE):
                rows = batch.slice(part.start, part.stop - part.start)
                hashes, _, _, bounds = hashed_words(*text_buffers(column[part]))
                lists: list[list[dict]] = [[] for _ in range(len(rows))]
                for doc, *one in known.scan(hashes, bounds, least):
                    lists[doc].append(dict(zip(kind.names, one, strict=True)))
                for found in lists:
                    found.sort(key=lambda x: (-x["coverage"], -x["words"], x["license_id"]))
                yield pa.RecordBatch.from_arrays(
                    [*rows.columns, pa.array(lists, pa.list_(kind))], names=[*batch.schema.names, "licenses"])

    return kept.mapInArrow(run, schema)
