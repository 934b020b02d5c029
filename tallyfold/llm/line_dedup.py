"""Removal of repeated blocks of lines, found by content-defined chunks.

A text is cut at line feeds, its lines into chunks: a boundary stands where a rolling hash over the last
lines meets a condition, so equal passages are cut alike wherever they stand. A chunk of two or more different lines
that are not blank, found more than once in the corpus, is kept where it comes first (least doc_id, then
position) and removed elsewhere.

A repeat whose ends are no boundaries reaches beyond its chunks, and a short one may hold none. So the short blocks
of a text are listed with the chunks: runs of two lines that are not blank, with the blank ones
between, and lines of at least 50 words. Those inside a copy of a chunk are settled with it. The others, around
copies and in text that no repeated chunk covers, extend a repeat line by line to both its ends, wherever it begins
and ends. Blank lines around a repeat go with a chunk only; those at the ends of a text with its first and last run.

A block may overlap others, so the first place of one can lose lines that stand in an earlier other one;
the first of all equal lines always stays. A run that overlaps an equal one, as where a line stands three
times, is no copy of that one.

Repeats are found by a 64-bit hash, then confirmed by the bytes: only blocks whose hash repeats are read
again and grouped by hash and bytes. Nothing is removed on a hash alone; two chunks that share one by chance could
at worst leave a short repeat in the later one. Counts and first places are combined in each task, so a block in
a third of all texts is one row a task.

Defined cases: null stays null and an empty text empty; a line goes with its line feed, and a text all of
whose lines go is empty, also one of a single long line unless ``one_line`` is false. Shorter lines with no
repeated neighbour are left alone. Rows with a null id come after all others. Rows
equal in id and text are treated alike: all keep their blocks if one of them holds the first place.
"""

from __future__ import annotations

from array import array
from bisect import bisect_right
from collections.abc import Iterator
from itertools import pairwise

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyfold.llm.frames import room_for
from tallyfold.llm.words import slices
from tallyfold.session import materialize

#: Lines over which the rolling hash runs.
WINDOW = 2
#: One boundary for so many lines, by chance.
DIVISOR = 2
LEAST_LINES, MOST_LINES = 2, 64
#: A line of so many words is a block by itself.
LONG_WORDS = 50
#: Bytes of text whose blocks are listed at once.
AT_ONCE = 1 << 20
CHUNK_FIELDS = ["_row", "doc_id", "start", "end", "hash"]
CHUNKS = ", ".join(f"{name} bigint" for name in CHUNK_FIELDS)
#: Columns of blocks: ``chunk`` is the first line of the chunk around a short block, null for a chunk.
BLOCK_FIELDS = [*CHUNK_FIELDS, "chunk"]
#: For a short block that lies in no single chunk.
ACROSS = -1


def _hash(raw: bytes) -> int:
    return xxhash.xxh3_64_intdigest(raw) - (1 << 63)


def line_chunks(
    lines: list[bytes], window: int = WINDOW, divisor: int = DIVISOR,
    least: int = LEAST_LINES, most: int = MOST_LINES,
) -> Iterator[tuple[int, int]]:
    """First line and end of each chunk. The last one may be shorter than ``least``."""
    hashes = [xxhash.xxh3_64_intdigest(line) for line in lines]
    mask, factor, start, rolling = (1 << 64) - 1, 0x9E3779B97F4A7C15, 0, 0
    out = pow(factor, window, 1 << 64)
    for i, h in enumerate(hashes):
        rolling = rolling * factor + h
        if i >= window:
            rolling -= hashes[i - window] * out
        rolling &= mask
        size = i + 1 - start
        # The high bits depend on all lines of the window.
        if (size >= least and i + 1 >= window and (rolling >> 33) % divisor == 0) or size == most:
            yield start, i + 1
            start = i + 1
    if start < len(lines):
        yield start, len(lines)


def _runs(lines: list[bytes], filled: list[int]) -> Iterator[tuple[int, int]]:
    """First line and end of each run of two of the lines ``filled``.

    Where one line stands three times or more, the second run overlaps the first one and is no copy of it:
    the first three lines stand for it.
    """
    pairs = [(i, j + 1, lines[i:j + 1]) for i, j in pairwise(filled)]
    nth = 0
    for k, (start, end, run) in enumerate(pairs):
        nth = nth + 1 if k and run == pairs[k - 1][2] else 0
        yield (pairs[k - 1][0] if nth == 1 else start), end


def _short_blocks(lines: list[bytes], filled: list[int]) -> set[tuple[int, int]]:
    """First line and end of the long lines and of the runs of two."""
    spans = {(i, i + 1) for i in filled if len(lines[i].split()) >= LONG_WORDS}
    spans.update(_runs(lines, filled))
    if 2 <= len(filled) < len(lines):
        spans |= {(0, filled[1] + 1), (filled[-2], len(lines))}
    return spans


def _blocks(lines: list[bytes]) -> Iterator[tuple[int, int, int | None]]:
    """First line, end and ``chunk`` of the blocks that may be removed: chunks, then short blocks."""
    filled = [i for i, line in enumerate(lines) if line.strip()]
    # One line over and over is left to the runs, which tell copies from overlaps.
    chunks = [
        (start, end) for start, end in line_chunks(lines)
        if len({line for line in lines[start:end] if line.strip()}) >= 2]
    for start, end in chunks:
        yield start, end, None
    starts = [start for start, _ in chunks]
    for start, end in sorted(_short_blocks(lines, filled).difference(chunks)):
        at = bisect_right(starts, start) - 1
        yield start, end, starts[at] if at >= 0 and end <= chunks[at][1] else ACROSS


def blocks(rows: DataFrame) -> DataFrame:
    """_row, doc_id, start, end (lines), hash and ``chunk`` of every block."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in _short(batches):
            keys, docs, inside = array("q"), [], []
            starts, ends, hashes = array("q"), array("q"), array("q")
            for key, doc, text in zip(
                batch.column(0).to_pylist(), batch.column(1).to_pylist(), batch.column(2), strict=True):
                if not text.is_valid:
                    continue
                lines = text.as_py().encode().split(b"\n")
                for start, end, chunk in _blocks(lines):
                    keys.append(key)
                    docs.append(doc)
                    starts.append(start)
                    ends.append(end)
                    hashes.append(_hash(b"\n".join(lines[start:end])))
                    inside.append(chunk)
            yield pa.RecordBatch.from_arrays([
                pa.array(np.frombuffer(keys, np.int64)), pa.array(docs, pa.int64()),
                *(pa.array(np.frombuffer(c, np.int64)) for c in (starts, ends, hashes)),
                pa.array(inside, pa.int64())], names=BLOCK_FIELDS)

    return rows.select("_row", "doc_id", "text").mapInArrow(run, f"{CHUNKS}, chunk bigint")


def chunk_bytes(rows: DataFrame) -> DataFrame:
    """The blocks listed in ``_spans`` with their bytes."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in _short(batches):
            made: list[list] = [[] for _ in CHUNK_FIELDS]
            raws = []
            keys, ids, texts, spans = (
                batch.column(batch.schema.get_field_index(c)) for c in ("_row", "doc_id", "text", "_spans"))
            for key, doc, text, listed in zip(
                keys.to_pylist(), ids.to_pylist(), texts, spans.to_pylist(), strict=True):
                lines = text.as_py().encode().split(b"\n")
                for s in listed:
                    raws.append(b"\n".join(lines[s["start"]:s["end"]]))
                    for column, value in zip(
                        made, (key, doc, s["start"], s["end"], s["hash"]), strict=True):
                        column.append(value)
            yield pa.RecordBatch.from_arrays(
                [*(pa.array(c, pa.int64()) for c in made), pa.array(raws, pa.binary())],
                names=[*CHUNK_FIELDS, "raw"])

    return rows.mapInArrow(run, f"{CHUNKS}, raw binary")


def _short(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The batches in runs of AT_ONCE bytes of text."""
    for batch in batches:
        for part in slices(batch.column(batch.schema.get_field_index("text")), AT_ONCE):
            yield batch.slice(part.start, part.stop - part.start)


def _same_row(one: DataFrame, other: DataFrame) -> Column:
    return (one["_row"] == other["_row"]) & one["doc_id"].eqNullSafe(other["doc_id"])


def _lists(chunks: DataFrame, *fields: str) -> DataFrame:
    """The blocks of each row in one list, as long as its text has blocks."""
    return chunks.groupBy("_row", "doc_id").agg(
        F.sort_array(F.collect_set(F.struct(*fields))).alias("_spans"))


def _order() -> Column:
    """Where a block stands; those of rows without an id come last."""
    return F.struct(F.col("doc_id").isNull().alias("late"), "doc_id", "start", "_row", "end")


def _same_place(one: DataFrame, other: DataFrame) -> Column:
    return _same_row(one, other) & (one["start"] == other["start"]) & (one["end"] == other["end"])


def _repeated(found: DataFrame, label: str) -> DataFrame:
    """The blocks whose hash stands more than once.

    The hashes are written, so that the join is one of plain shuffles, whose skewed parts can be split.
    """
    hashes = materialize(
        found.groupBy("hash").agg(F.count("*").alias("n")).filter("n > 1").select("hash"), label)
    return found.join(hashes, "hash").select(*BLOCK_FIELDS)


def open_places(found: DataFrame) -> DataFrame:
    """The blocks to be compared by their bytes: repeated chunks, and short blocks that no copy of one holds."""
    places = materialize(_repeated(found, "repeated"), "places")
    firsts = places.groupBy("hash").agg(F.min(_order()).alias("first")).select("first.*")
    chunks = places.filter("chunk is null")
    copies = chunks.join(firsts, _same_place(chunks, firsts), "left_anti").select(
        F.col("_row").alias("copy_row"), F.col("doc_id").alias("copy_id"), F.col("start").alias("copy_start"),
    ).distinct()
    left = places.filter("chunk is not null").join(
        copies, F.expr("_row = copy_row and doc_id <=> copy_id and chunk = copy_start"), "left_anti")
    # A short block whose other places are all settled stands alone now.
    left = materialize(chunks.unionByName(left), "left")
    return materialize(_repeated(left, "repeated-left"), "open").select(*CHUNK_FIELDS)


def without_repeated_lines(docs: DataFrame, one_line: bool = True) -> DataFrame:
    """``docs`` with the text left and ``removed``, the line spans (start, end) taken out.

    Spans may overlap. Without ``one_line``, texts of one line stay, though other texts lose that line.
    The texts are shuffled once, by row; both joins read that shuffle. Columns named removed, _row
    and _spans are replaced or dropped.
    """
    kept, _ = room_for(docs, "removed int, _row int, _spans int")
    rows = kept.withColumn("_row", F.xxhash64("doc_id", "text"))
    places = open_places(materialize(blocks(rows), "blocks"))
    lists = _lists(places, "start", "end", "hash")
    read = chunk_bytes(rows.join(lists, _same_row(rows, lists)).drop(lists["_row"], lists["doc_id"]))
    # Grouped by their bytes: the first place of each block, of which there is one for each hash
    # unless two blocks share it.
    firsts = read.groupBy("hash", "raw").agg(F.min(_order()).alias("first")).select("first.*")
    others = places.join(firsts, _same_place(places, firsts), "left_anti")
    gone = _lists(others, "start", "end")
    joined = rows.join(gone, _same_row(rows, gone), "left").drop(gone["_row"], gone["doc_id"])
    if not one_line:
        joined = joined.withColumn("_spans", F.when(F.col("text").contains("\n"), F.col("_spans")))
    # Places of the lines left, by a hash set: the time grows with the lines, however many spans there are.
    taken = F.flatten(F.transform("_spans", lambda s: F.sequence(s["start"], s["end"] - 1)))
    kept = F.transform(F.array(F.split("text", "\n", -1)), lambda lines: F.array_join(F.transform(
        F.array_except(F.sequence(F.lit(0).cast("long"), F.size(lines).cast("long") - 1), taken),
        lambda i: F.get(lines, i.cast("int"))), "\n"))[0]
    return joined.withColumn(
        "text", F.when(F.col("_spans").isNull(), F.col("text")).otherwise(kept),
    ).withColumn(
        "removed", F.coalesce("_spans", F.array().cast("array<struct<start: bigint, end: bigint>>")),
    ).drop("_row", "_spans")
