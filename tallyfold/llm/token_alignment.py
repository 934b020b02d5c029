"""Alignment of the tokens of two tokenizers over the bytes of each text, in Arrow tables.

Tokenizer A takes a space and the text, B the text (it puts the space in front by itself). In each run of texts:

1. The lists of ids are flattened, with the text each comes from (its parent); lengths of their bytes are added up
   in one running sum, from which each text's start is taken off: the byte where every token ends.
2. A hash join of both tables on (text, end), full outer and put in order, gives the ends of either. Each stands for one
   pair of tokens that overlap: the next token of A and the next of B that end there or later. Ends of both
   close a group.
3. The pairs are counted by text and by block (texts of about ``BLOCK_BYTES``) with Arrow's group-by. Only the distinct
   pairs of a block go to Spark, which adds the counts up over all blocks, finds the most linked partners
   of each id of B, and sends every block the totals of its own pairs.

So neither texts nor tokens are shuffled: a block is written as its texts' packed pairs and read once more. The
number of pairs of a block is bounded by its bytes, also for a pair that stands in every text.

Defined cases: null and empty texts have no tokens, nor have texts whose tokens of A or B do not give back the
bytes of the space and the text (as where B's normalisation changes a character): all numbers 0, groups ''. Strings of special
tokens are text. Rows with null or equal ids are rows of their own. Further columns are left out. An empty table gives no rows.
"""

from __future__ import annotations

import functools
import hashlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import sentencepiece
import zstandard
from pyspark import SparkFiles, TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyfold.llm.bpe import Encoder, Vocabulary
from tallyfold.llm.words import slices, text_buffers
from tallyfold.session import materialize

#: Bytes of text encoded at once, and texts of a block.
AT_ONCE, BLOCK_BYTES = 2 << 20, 8 << 20
#: The id of A in the high half of a pair, that of B in the low one.
HALF = 32
#: Places of a text and of an end in the key of a join.
END_BITS = 40

NUMBERS = ("n_a", "n_b", "n_groups", "n_links")
BLOCK = pa.schema([
    ("block", pa.int64()), ("doc_id", pa.list_(pa.int64())), *((n, pa.list_(pa.int64())) for n in NUMBERS),
    ("groups", pa.list_(pa.string())), ("n_pairs", pa.list_(pa.int32())), ("packed", pa.binary()),
    ("pairs", pa.list_(pa.int64())), ("counts", pa.list_(pa.int64())),
])
BLOCK_DDL = "block long, doc_id array<long>, " + "".join(f"{n} array<long>, " for n in NUMBERS) + (
    "groups array<string>, n_pairs array<int>, packed binary, pairs array<long>, counts array<long>")


class Pair:
    """Both tokenizers and the bytes of their tokens."""

    def __init__(self, path_a: str, path_b: str) -> None:
        with open(path_a, encoding="utf-8") as f:
            vocab = Vocabulary(f.read())
        self.bytes_a = pa.array(vocab.bytes, pa.large_binary())
        vocab.special = {}  # their strings are text
        self.a = Encoder(vocab)
        self.b = sentencepiece.SentencePieceProcessor(model_file=path_b)
        self.bytes_b = pa.array([self._piece(i) for i in range(self.b.get_piece_size())], pa.large_binary())

    def _piece(self, i: int) -> bytes:
        piece = self.b.id_to_piece(i)
        return bytes([int(piece[3:5], 16)]) if self.b.is_byte(i) else piece.replace("▁", " ").encode()

    def encode_a(self, texts: list[str]) -> pa.ListArray:
        ids, bounds = self.a.encode([f" {t}" for t in texts])
        return pa.ListArray.from_arrays(pa.array(bounds, pa.int32()), pa.array(ids))

    def encode_b(self, texts: list[str]) -> pa.ListArray:
        return pa.array(self.b.encode(texts, num_threads=1), pa.list_(pa.int32()))


@functools.lru_cache(maxsize=2)
def _loaded(file_a: str, file_b: str) -> Pair:
    return Pair(SparkFiles.get(file_a), SparkFiles.get(file_b))


def faithful(lists: pa.ListArray, spelt: pa.Array, texts: list[str]) -> np.ndarray:
    """Whether the bytes of each list's tokens are those of a space and the text."""
    joined = spelt.take(pc.list_flatten(lists))
    _, offsets, data = joined.buffers()
    at = np.frombuffer(offsets, np.int64)[:len(joined) + 1][lists.offsets.to_numpy()]
    raw = memoryview(data) if data is not None else memoryview(b"")
    return np.array([
        raw[i:j].tobytes() == f" {t}".encode()
        for i, j, t in zip(at[:-1].tolist(), at[1:].tolist(), texts, strict=True)], bool)


def token_ends(lists: pa.ListArray, spelt: pa.Array, name: str) -> pa.Table:
    """key (text and the byte where the token ends), the id as ``name`` and the token's place as ``name``_at."""
    ids, parent = pc.list_flatten(lists), pc.list_parent_indices(lists)
    running = pc.cumulative_sum(pc.binary_length(spelt).take(ids).cast(pa.int64()))
    upto = pa.concat_arrays([pa.array([0], pa.int64()), running])
    start = upto.take(lists.offsets).take(parent)
    key = pc.add(pc.shift_left(parent.cast(pa.int64()), END_BITS), pc.subtract(running, start))
    return pa.table({"key": key, name: ids, f"{name}_at": pa.array(np.arange(len(ids)))})


def links(a: pa.Table, b: pa.Table) -> pa.Table:
    """One row for each pair of overlapping tokens, in order: text, a, b, and whether a and b end there."""
    both = a.join(b, "key", join_type="full outer", use_threads=False).combine_chunks()
    both = both.take(pc.sort_indices(both, sort_keys=[("key", "ascending")]))
    ends = {f"{x}_ends": pc.is_valid(both[x]) for x in ("a", "b")}
    filled = {x: pc.fill_null_backward(both[x].combine_chunks()) for x in ("a", "b")}
    return pa.table({"text": pc.shift_right(both["key"], END_BITS), **filled, **ends})


def group_texts(linked: pa.Table, texts: int) -> pa.Array:
    """For each text its groups: ids of A, a bar, ids of B; groups parted by a semicolon."""
    ends_a, ends_b = (linked[f"{x}_ends"].to_numpy() for x in ("a", "b"))
    closes = ends_a & ends_b
    group = np.cumsum(closes) - closes  # the number of groups closed before
    of_a, of_b = group[ends_a], group[ends_b]
    many = int(closes.sum())
    n_a, n_b = np.bincount(of_a, minlength=many), np.bincount(of_b, minlength=many)
    # Tokens of a group: those of A, then those of B.
    at_a = np.arange(len(of_a)) + (np.cumsum(n_b) - n_b)[of_a]
    at_b = np.arange(len(of_b)) + np.cumsum(n_a)[of_b]
    order = np.empty(len(at_a) + len(at_b), np.int64)
    order[at_a], order[at_b] = np.arange(len(at_a)), len(at_a) + np.arange(len(at_b))
    ids = pa.concat_arrays([
        linked[x].combine_chunks().filter(pa.array(e)) for x, e in (("a", ends_a), ("b", ends_b))]).take(pa.array(order))
    # Code of what follows each token.
    after = np.zeros(len(ids), np.int8)
    last_b = np.cumsum(n_a + n_b) - 1
    after[last_b - n_b], after[last_b] = 1, 2
    text = linked["text"].to_numpy()
    tokens = np.bincount(text[ends_a], minlength=texts) + np.bincount(text[ends_b], minlength=texts)
    bounds = np.concatenate(([0], np.cumsum(tokens)))
    after[bounds[1:][tokens > 0] - 1] = 3
    marks = pa.array([",", "|", ";", ""]).take(pa.array(after))
    spelt = pc.binary_join_element_wise(ids.cast(pa.string()), marks, "")
    lists = pa.LargeListArray.from_arrays(pa.array(bounds), spelt.cast(pa.large_string()))
    return pc.binary_join(lists, pa.scalar("", pa.large_string()))


def _per_text(linked: pa.Table, texts: int) -> pa.Table:
    """Numbers of each text; groups are added by the caller."""
    text = linked["text"].to_numpy()
    ends_a, ends_b = (linked[f"{x}_ends"].to_numpy() for x in ("a", "b"))
    counted = {name: np.bincount(text[e], minlength=texts) for name, e in zip(
        NUMBERS, (ends_a, ends_b, ends_a & ends_b, np.ones(len(text), bool)), strict=True)}
    return pa.table({name: pa.array(n, pa.int64()) for name, n in counted.items()})


def aligned_run(pair: Pair, texts: list[str | None]) -> tuple[pa.Table, pa.Array, pa.Table]:
    """For one run of texts: their numbers, their groups, and (text, pair, n) of their distinct pairs."""
    full = [t or "" for t in texts]
    a, b = pair.encode_a(full), pair.encode_b(full)
    good = np.array([bool(t) for t in full], bool)
    good &= faithful(a, pair.bytes_a, full) & faithful(b, pair.bytes_b, full)
    if not good.all():
        kept, none = pa.array(good), pa.array([[]], pa.list_(pa.int32()))[0]
        a, b = (pc.if_else(kept, x, none) for x in (a, b))
    linked = links(token_ends(a, pair.bytes_a, "a"), token_ends(b, pair.bytes_b, "b"))
    both = pc.bit_wise_or(pc.shift_left(linked["a"].cast(pa.int64()), HALF), linked["b"].cast(pa.int64()))
    counted = pa.table({"text": linked["text"], "pair": both}).group_by(
        ["text", "pair"], use_threads=False).aggregate([([], "count_all")]).rename_columns(["text", "pair", "n"])
    return _per_text(linked, len(texts)), group_texts(linked, len(texts)), counted


def _packed(places: np.ndarray, n: np.ndarray) -> bytes:
    """Places (rising within a text) and numbers of pairs, small."""
    numbers = np.stack((np.diff(places, prepend=0), n)).astype(np.int32)
    return zstandard.ZstdCompressor(level=1).compress(numbers.view(np.uint8).reshape(-1, 4).T.tobytes())


def _unpacked(raw: bytes) -> tuple[np.ndarray, np.ndarray]:
    planes = np.frombuffer(zstandard.ZstdDecompressor().decompress(raw), np.uint8).reshape(4, -1)
    numbers = np.ascontiguousarray(planes.T).view(np.int32).reshape(2, -1)
    return np.cumsum(numbers[0], dtype=np.int64), numbers[1].astype(np.int64)


class _Block:
    """Texts gathered until they are enough for a row of BLOCK."""

    def __init__(self) -> None:
        self.ids: list[pa.Array] = []
        self.numbers: list[pa.Table] = []
        self.groups: list[pa.Array] = []
        self.pairs: list[pa.Table] = []
        self.texts = self.size = 0

    def add(self, ids: pa.Array, numbers: pa.Table, groups: pa.Array, counted: pa.Table, size: int) -> None:
        self.ids.append(ids.cast(pa.int64()))
        self.numbers.append(numbers)
        self.groups.append(groups)
        self.pairs.append(counted.set_column(0, "text", pc.add(counted["text"], self.texts)))
        self.texts += len(ids)
        self.size += size

    def row(self, number: int) -> pa.RecordBatch:
        counted = pa.concat_tables(self.pairs).sort_by([("text", "ascending"), ("pair", "ascending")])
        total = counted.group_by("pair", use_threads=False).aggregate([("n", "sum")]).sort_by("pair")
        text, n = counted["text"].to_numpy(), counted["n"].to_numpy()
        places = np.searchsorted(total["pair"].to_numpy(), counted["pair"].to_numpy())
        numbers = pa.concat_tables(self.numbers)
        one = {
            "block": number, "doc_id": pa.concat_arrays(self.ids), **{c: numbers[c] for c in NUMBERS},
            "groups": pa.concat_arrays(self.groups), "n_pairs": np.bincount(text, minlength=self.texts).astype(np.int32),
            "packed": _packed(places, n), "pairs": total["pair"], "counts": total["n_sum"]}
        return pa.RecordBatch.from_arrays([_single(one[f.name], f.type) for f in BLOCK], schema=BLOCK)


def _single(value, kind: pa.DataType) -> pa.Array:
    """A column of one row."""
    if not pa.types.is_list(kind):
        return pa.array([value], kind)
    items = value.combine_chunks() if isinstance(value, pa.ChunkedArray) else value
    items = items if isinstance(items, pa.Array) else pa.array(items)
    return pa.ListArray.from_arrays(pa.array([0, len(items)], pa.int32()), items.cast(kind.value_type))


def _digests(groups: pa.Array) -> pa.Array:
    return pa.array([
        hashlib.sha256(g.as_buffer()).hexdigest() if len(g.as_buffer()) else "" for g in groups], pa.string())


def aligned(docs: DataFrame, path_a: str, path_b: str, digests: bool = False,
            block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """One row for each row of ``docs``: doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups.

    n_best: links whose pair is found as often as any of its id of B, in all texts; count_sum: how often the pairs of the
    text's links are found in all. ``groups``: ``a1,a2|b1;a3|b2,b3`` of ids, or with ``digests`` the SHA-256 of that
    (nothing for nothing), which keeps what is written small.
    """
    spark = docs.sparkSession
    for path in (path_a, path_b):
        spark.sparkContext.addFile(path)
    files = path_a.rsplit("/", 1)[-1], path_b.rsplit("/", 1)[-1]
    shown: Callable[[pa.Array], pa.Array] = _digests if digests else (lambda groups: groups.cast(pa.string()))

    def blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        # A number used once: of two tries of a task only one is written.
        number = TaskContext.get().partitionId() << 32
        block = _Block()
        for batch in batches:
            for part in slices(batch.column(1), AT_ONCE):
                texts = batch.column(1)[part]
                numbers, groups, counted = aligned_run(_loaded(*files), texts.to_pylist())
                block.add(batch.column(0)[part], numbers, shown(groups), counted, int(text_buffers(texts)[1][-1]))
                if block.size >= block_bytes:
                    yield block.row(number)
                    block, number = _Block(), number + 1
        if block.texts:
            yield block.row(number)

    made = materialize(docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(blocks, BLOCK_DDL), "blocks")
    own = made.select("block", F.posexplode(F.arrays_zip("pairs", "counts")).alias("place", "one")).select(
        "block", "place", F.col("one.pairs").alias("pair"), F.col("one.counts").alias("n"))
    totals = materialize(own.groupBy("pair").agg(F.sum("n").alias("total")), "pair-totals")
    # An id of B has at most as many partners as A has ids.
    of_b = F.col("pair").bitwiseAND(F.lit((1 << HALF) - 1)).alias("id_b")
    most = totals.groupBy(of_b).agg(F.max("total").alias("most"))
    judged = totals.withColumn("id_b", of_b).join(most, "id_b").select(
        "pair", "total", (F.col("total") == F.col("most")).alias("best"))
    known = own.select("block", "place", "pair").join(materialize(judged, "judged"), "pair")
    lists = known.groupBy("block").agg(
        F.sort_array(F.collect_list(F.struct("place", "total", "best"))).alias("known"))
    lists = lists.select("block", F.col("known.total").alias("totals"), F.col("known.best").alias("best"))
    rows = made.drop("pairs", "counts").join(lists, "block", "left")
    return rows.mapInArrow(_summed, "doc_id long, " + ", ".join(f"{n} long" for n in NUMBERS) + (
        ", n_best long, count_sum long, groups string"))


def _summed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows of the texts of each block, with the sums over their links."""
    for batch in batches:
        for i in range(len(batch)):
            row = {name: batch.column(name)[i] for name in batch.schema.names}
            places, n = _unpacked(row["packed"].as_py())
            of_text = np.repeat(np.arange(len(row["doc_id"].values)), row["n_pairs"].values.to_numpy())
            sums = np.zeros((2, len(row["doc_id"].values)), np.int64)
            if len(places):
                total = row["totals"].values.to_numpy()
                best = row["best"].values.to_numpy(zero_copy_only=False)
                np.add.at(sums[0], of_text, np.where(best[places], n, 0))
                np.add.at(sums[1], of_text, n * total[places])
            yield pa.RecordBatch.from_arrays(
                [row["doc_id"].values, *(row[c].values for c in NUMBERS), pa.array(sums[0]), pa.array(sums[1]),
                 row["groups"].values], names=["doc_id", *NUMBERS, "n_best", "count_sum", "groups"])
