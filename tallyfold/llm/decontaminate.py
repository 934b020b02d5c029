"""Benchmark decontamination by FM-indexes over shards of the training texts.

A shard is a run of documents of one partition. Its words are laid end to end, a wall after each
document, and indexed whole: the suffixes are sorted, the word before each suffix gives the
Burrows-Wheeler transform, a wavelet matrix answers how often a word occurs in a prefix of it,
and the text positions of some suffixes are kept. All phrases are then searched backward at once,
last word first; the rows that remain are located by stepping to the next kept position.

The phrases of an item are its windows of ``window`` words; an item with fewer words, but not none,
is one phrase. A word inside any occurrence of a phrase is hit. The phrases go to the tasks in
blocks of a fixed size, one search of the corpus for each block, so that no block grows
with the benchmark.

Defined cases: null and empty texts have no words, hold nothing and, as items, mark nothing.
Repeated documents are searched each; an item that is listed twice counts once for each id.
A document longer than a shard is cut into shards that overlap by a window. Words are compared by
64-bit hashes of their lower-cased bytes; A-Z only are lower-cased.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyfold.llm.frames import room_for
from tallyfold.llm.words import hashed_words, slices, text_buffers

#: Words of a phrase.
WINDOW = 10
#: Words in a shard at most.
SHARD_WORDS = 1 << 19
#: Bytes of text that are read into shards at once.
SHARD_BYTES = 3 << 20
#: One suffix position is kept for so many text positions.
KEPT_EVERY = 8
#: Words of benchmark phrases that are sent to the tasks at once (8 bytes a word).
BLOCK_WORDS = 1 << 21

END, WALL = 0, 1
SPAN = "struct<first: bigint, last: bigint, start: bigint, stop: bigint>"


def suffix_order(text: np.ndarray) -> np.ndarray:
    """Start positions of the suffixes of ``text`` in order. Its last symbol must be its least.

    Suffixes are first ranked by their first symbols, as many as fit 62 bits; then, as long as
    some share a rank, these alone are ranked by twice as many.
    """
    n, bits = len(text), max(1, int(text.max()).bit_length())
    depth = min(n, max(1, 62 // bits))
    key = np.zeros(n, np.int64)
    for i in range(depth):
        key <<= bits
        key[:n - i] |= text[i:]
    order = np.argsort(key, kind="stable")
    key = key[order]
    first = np.append(True, key[1:] != key[:-1])
    del key
    place = np.arange(n)
    rank = np.empty(n, np.int64)
    rank[order] = np.maximum.accumulate(np.where(first, place, 0))
    # Places in order whose rank is shared.
    shared = np.flatnonzero(~first | ~np.append(first[1:], True))
    while len(shared):
        at = order[shared]
        after = at + depth
        second = np.where(after < n, rank[np.minimum(after, n - 1)], -1)
        key = rank[at] * (n + 1) + second + 1
        sub = np.argsort(key, kind="stable")
        key, at = key[sub], at[sub]
        # Groups lie one behind another, so sorting by rank first keeps each at its places.
        order[shared] = at
        first = np.append(True, key[1:] != key[:-1])
        rank[at] = shared[np.maximum.accumulate(np.where(first, np.arange(len(at)), 0))]
        shared = shared[~first | ~np.append(first[1:], True)]
        depth *= 2
    return order


class WaveletMatrix:
    """Counts of a symbol in prefixes of a sequence, a bit plane at a time."""

    def __init__(self, symbols: np.ndarray, bits: int) -> None:
        self.planes: list[tuple[int, np.ndarray, int]] = []
        for bit in range(bits - 1, -1, -1):
            ones = (symbols >> bit & 1).astype(bool)
            zeros_before = np.zeros(len(symbols) + 1, np.int32)
            np.cumsum(~ones, out=zeros_before[1:])
            self.planes.append((bit, zeros_before, int(zeros_before[-1])))
            symbols = np.concatenate((symbols[~ones], symbols[ones]))

    def walk(self, symbol: np.ndarray, at: np.ndarray) -> np.ndarray:
        """Where prefixes end among the symbols sorted by reversed bits."""
        for bit, zeros_before, zeros in self.planes:
            low = zeros_before[at]
            at = np.where(symbol >> bit & 1, zeros + at - low, low)
        return at


class FMIndex:
    """Index of a sequence of word numbers of at least 2, with walls, whose last symbol is END."""

    def __init__(self, text: np.ndarray, kept_every: int = KEPT_EVERY) -> None:
        order = suffix_order(text)
        self.transform = text[order - 1]
        self.size = int(text.max()) + 1
        counts = np.bincount(text, minlength=self.size)
        self.before = np.concatenate(([0], np.cumsum(counts)))
        self.ranks = WaveletMatrix(self.transform, max(1, (self.size - 1).bit_length()))
        self.base = self.before[:-1] - self.ranks.walk(
            np.arange(self.size), np.zeros(self.size, np.int64))
        kept = order % kept_every == 0
        self.kept_before = np.concatenate(([0], np.cumsum(kept)))
        self.kept, self.is_kept = order[kept], kept

    def step(self, symbol: np.ndarray, row: np.ndarray) -> np.ndarray:
        """Rows of the suffixes with ``symbol`` put before those above ``row``."""
        return self.base[symbol] + self.ranks.walk(symbol, row)

    def search(self, phrases: np.ndarray, lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """First row, and the row after the last, of each phrase's occurrences; equal if none.

        ``phrases`` holds a phrase in each row, its words at the left, -1 for unknown words.
        """
        low = np.zeros(len(phrases), np.int64)
        high = np.full(len(phrases), len(self.transform))
        for back in range(1, phrases.shape[1] + 1):
            alive = np.flatnonzero((lengths >= back) & (high > low))
            symbol = phrases[alive, lengths[alive] - back]
            high[alive[symbol < 0]] = low[alive[symbol < 0]]
            alive, symbol = alive[symbol >= 0], symbol[symbol >= 0]
            low[alive] = self.step(symbol, low[alive])
            high[alive] = self.step(symbol, high[alive])
        return low, high

    def locate(self, rows: np.ndarray) -> np.ndarray:
        """Text positions of rows: steps back through the text to the next kept position."""
        found, steps = np.empty(len(rows), np.int64), 0
        open_, row = np.arange(len(rows)), rows.copy()
        while len(open_):
            done = self.is_kept[row]
            found[open_[done]] = self.kept[self.kept_before[row[done]]] + steps
            open_, row = open_[~done], row[~done]
            row = self.step(self.transform[row], row)
            steps += 1
        return found


class Phrases:
    """Distinct phrases of some items, and the items that have them."""

    def __init__(self, items: np.ndarray, hashes: np.ndarray, bounds: np.ndarray, window: int) -> None:
        """Item i has the words hashes[bounds[i]:bounds[i+1]]."""
        sizes = np.diff(bounds)
        counts = np.where(sizes > 0, np.maximum(sizes - window, 0) + 1, 0)
        owner = np.repeat(np.arange(len(items)), counts)
        start = bounds[owner] + np.arange(len(owner)) - (np.cumsum(counts) - counts)[owner]
        self.words, number = np.unique(hashes, return_inverse=True)
        length = np.minimum(sizes[owner], window)
        reach = np.arange(window)
        inside = reach < length[:, None]
        at = np.minimum(start[:, None] + reach, max(len(number) - 1, 0))
        table = np.where(inside, number[at] if len(number) else 0, -1)
        self.table, same = np.unique(table, axis=0, return_inverse=True)
        self.lengths = (self.table >= 0).sum(axis=1)
        order = np.argsort(same.ravel(), kind="stable")
        self.items, self.owners = items, owner[order]
        self.owned = np.searchsorted(same.ravel()[order], np.arange(len(self.table) + 1))

    def in_shard(self, uniques: np.ndarray) -> np.ndarray:
        """The phrases in a shard's numbers for words."""
        at = np.minimum(np.searchsorted(uniques, self.words), max(len(uniques) - 1, 0))
        known = uniques[at] == self.words if len(uniques) else np.zeros(len(self.words), bool)
        numbers = np.append(np.where(known, at + 2, -1), -1)
        return numbers[self.table]


def _pieces(bounds: np.ndarray, most: int, overlap: int) -> Iterator[tuple[int, int, int]]:
    """First document, first word and end of each shard; only a long document is cut."""
    doc, n = 0, len(bounds) - 1
    while doc < n:
        last = max(int(np.searchsorted(bounds, bounds[doc] + most, side="right")) - 1, doc + 1)
        if bounds[last] - bounds[doc] <= most:
            yield doc, int(bounds[doc]), int(bounds[last])
        else:
            for start in range(int(bounds[doc]), int(bounds[last]) - overlap, most - overlap):
                yield doc, start, min(start + most, int(bounds[last]))
        doc = last


def occurrences(
    hashes: np.ndarray, bounds: np.ndarray, phrases: Phrases, most: int = SHARD_WORDS
) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Phrase and first word (as an index of ``hashes``) of every occurrence, shard by shard."""
    if not len(phrases.table):
        return
    for doc, start, end in _pieces(bounds, most, phrases.table.shape[1] - 1):
        words = hashes[start:end]
        uniques, number = np.unique(words, return_inverse=True)
        # Walls go where a document ends inside the shard; END closes it.
        inner = bounds[doc + 1:]
        inner = inner[(inner < end)] - start
        text = np.append(np.insert(number.astype(np.int64) + 2, inner, WALL), END)
        index = FMIndex(text)
        low, high = index.search(phrases.in_shard(uniques), phrases.lengths)
        counts = high - low
        some = np.flatnonzero(counts)
        if not len(some):
            continue
        counts = counts[some]
        within = np.arange(counts.sum()) - np.repeat(np.cumsum(counts) - counts, counts)
        at = index.locate(np.repeat(low[some], counts) + within)
        walls = np.searchsorted(inner + np.arange(len(inner)), at)
        yield np.repeat(some, counts), at - walls + start


def marks(
    docs: DataFrame, phrases_block: bytes, window: int, text: str = "text",
    shard_words: int = SHARD_WORDS,
) -> DataFrame:
    """Adds the number of words, the hit spans and the items found to each document.

    A span is a run of hit words: its first word and the word after its last, counted from 0, and
    the same as byte positions in the UTF-8 text.
    """
    shared = docs.sparkSession.sparkContext.broadcast(phrases_block)
    kept, schema = room_for(docs, f"n_words bigint, hits array<{SPAN}>, items array<string>")
    span = pa.struct([(name, pa.int64()) for name in ("first", "last", "start", "stop")])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        with pa.ipc.open_stream(shared.value) as reader:
            listed = reader.read_all()
        lists = listed["words"].combine_chunks()
        phrases = Phrases(
            np.array(listed["item"].to_pylist(), dtype=object),
            lists.values.to_numpy().view(np.uint64), lists.offsets.to_numpy().astype(np.int64), window)
        for batch in batches:
            column = batch.column(batch.schema.get_field_index(text))
            for part in slices(column, SHARD_BYTES):
                rows = batch.slice(part.start, part.stop - part.start)
                data, offsets = text_buffers(column[part])
                hashes, starts, ends, bounds = hashed_words(data, offsets)
                hit = np.zeros(len(hashes) + 1, np.int32)
                found: list[np.ndarray] = []
                for phrase, at in occurrences(hashes, bounds, phrases, shard_words):
                    np.add.at(hit, at, 1)
                    np.add.at(hit, at + phrases.lengths[phrase], -1)
                    doc = np.searchsorted(bounds, at, side="right") - 1
                    found.append(np.unique(np.stack((doc, phrase), axis=1), axis=0))
                inside = np.cumsum(hit[:-1]) > 0
                items: list[set[str]] = [set() for _ in range(len(rows))]
                for doc, phrase in (np.concatenate(found).tolist() if found else []):
                    owners = phrases.owners[phrases.owned[phrase]:phrases.owned[phrase + 1]]
                    items[doc].update(phrases.items[owners].tolist())
                spans, span_bounds = _merged(inside, bounds, starts, ends, offsets)
                yield pa.RecordBatch.from_arrays([
                    *rows.columns,
                    pa.array(np.diff(bounds), pa.int64()),
                    pa.ListArray.from_arrays(
                        pa.array(span_bounds, pa.int32()),
                        pa.StructArray.from_arrays([pa.array(x) for x in spans], fields=list(span))),
                    pa.array([sorted(x) for x in items], pa.list_(pa.string())),
                ], names=[*batch.schema.names, "n_words", "hits", "items"])

    return kept.mapInArrow(run, schema)


def _merged(inside, bounds, starts, ends, offsets):
    """Runs of hit words of each document: byte positions in its text, and words."""
    edge = np.zeros(len(inside) + 1, bool)
    edge[bounds] = True
    first = np.flatnonzero(inside & (edge[:-1] | ~np.append(False, inside[:-1])))
    last = np.flatnonzero(inside & (edge[1:] | ~np.append(inside[1:], False)))
    doc = np.searchsorted(bounds, first, side="right") - 1
    base = offsets[doc]
    counts = np.bincount(doc, minlength=len(bounds) - 1)
    return (
        (first - bounds[doc], last + 1 - bounds[doc], starts[first] - base, ends[last] - base),
        np.concatenate(([0], np.cumsum(counts))),
    )


def phrase_blocks(
    benchmark: DataFrame, item: str = "item_id", text: str = "text", block_words: int = BLOCK_WORDS
) -> Iterator[bytes]:
    """The benchmark's words in blocks of bounded size; rows reach the driver one partition at a time."""
    words = benchmark.select(F.col(item).cast("string").alias("item"), F.col(text).alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, offsets = text_buffers(batch.column(1))
            hashes, _, _, bounds = hashed_words(data, offsets)
            lists = pa.ListArray.from_arrays(pa.array(bounds, pa.int32()), pa.array(hashes.view(np.int64)))
            yield pa.RecordBatch.from_arrays([batch.column(0), lists], names=["item", "words"])

    listed = words.mapInArrow(run, "item string, words array<bigint>").filter("item is not null")
    held, size = [], 0
    for row in listed.filter(F.size("words") > 0).toLocalIterator():
        if size and size + len(row["words"]) > block_words:
            yield _packed(held)
            held, size = [], 0
        held.append(row)
        size += len(row["words"])
    if held:
        yield _packed(held)


def _packed(rows: list) -> bytes:
    table = pa.table({
        "item": pa.array([r["item"] for r in rows], pa.string()),
        "words": pa.array([r["words"] for r in rows], pa.list_(pa.int64())),
    })
    sink = pa.BufferOutputStream()
    with pa.ipc.new_stream(sink, table.schema) as writer:
        writer.write_table(table.combine_chunks())
    return sink.getvalue().to_pybytes()


def contaminated(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW) -> DataFrame:
    """Documents with n_words, hits (merged spans) and items (ids found, sorted as strings).

    A benchmark that fits one block, as nearly all do, takes one pass over the documents. Each
    further block searches them again and its spans are united with those before.
    """
    found = None
    for block in phrase_blocks(benchmark):
        if found is None:
            found = marks(docs, block, window)
            continue
        before = found.withColumnsRenamed({"hits": "_hits", "items": "_items"}).drop("n_words")
        found = marks(before, block, window).withColumns({
            "hits": united(F.concat("_hits", "hits")),
            "items": F.array_sort(F.array_union("_items", "items")),
        }).drop("_hits", "_items")
    return marks(docs, _packed([]), window) if found is None else found


def united(spans: Column) -> Column:
    """Spans of one document without those that overlap or touch, as unions of them."""
    def fold(done: Column, span: Column) -> Column:
        last = F.element_at(done, -1)
        joined = F.struct(
            last["first"].alias("first"), F.greatest(last["last"], span["last"]).alias("last"),
            last["start"].alias("start"), F.greatest(last["stop"], span["stop"]).alias("stop"))
        return F.when(
            (F.size(done) > 0) & (F.try_element_at(done, F.lit(-1))["last"] >= span["first"]),
            F.concat(F.slice(done, 1, F.greatest(F.size(done) - 1, F.lit(0))), F.array(joined)),
        ).otherwise(F.concat(done, F.array(span)))

    return F.aggregate(F.array_sort(spans), F.array().cast(f"array<{SPAN}>"), fold)


def hit_words(spans: Column | str) -> Column:
    """Words inside merged spans."""
    return F.aggregate(spans, F.lit(0).cast("long"), lambda n, s: n + s["last"] - s["first"])


def without_hits(text: Column | str, spans: Column | str) -> Column:
    """The text without its spans, which are byte positions in its UTF-8 form."""
    raw = F.encode(text, "utf-8")
    kept = F.aggregate(
        spans,
        F.struct(F.lit(0).cast("long").alias("at"), F.lit("").alias("text")),
        lambda done, s: F.struct(s["stop"].alias("at"), F.concat(done["text"], F.decode(F.substring(
            raw, (done["at"] + 1).cast("int"), (s["start"] - done["at"]).cast("int")), "utf-8")).alias("text")),
        lambda done: F.concat(done["text"], F.decode(F.substring(
            raw, (done["at"] + 1).cast("int"), F.octet_length(raw)), "utf-8")),
    )
    return F.when(F.size(spans) > 0, kept).otherwise(F.col(text) if isinstance(text, str) else text)
