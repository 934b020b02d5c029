"""Collocations of a corpus by partitioned mining (SON): local candidates, then exact counts.

A phrase found ``least`` times in all is found at least ``least / shards`` times in one of the shards,
whatever their sizes. So:

1. Documents are dealt into a few shards by a hash. Each shard is mined completely at that lowered
   support, level by level: words and pairs of words first, then phrases of one word more, of which
   only those are counted whose two shorter parts are frequent in the same shard. A support of 10 leaves room for
   few shards (from 10 on, the local support would be 1 and prune nothing), so a shard is far larger than a
   task: tasks count their own runs of texts, and a combining group-by over 64-bit hashes adds them up.
2. The locally frequent hashes of all shards are united in a bit filter of bounded size. A hash shared by two
   phrases, or a filter that is full, lets more phrases through, never fewer.
3. One more pass counts the phrases that pass the filter, now by their words, and only those enough times found stay.

Words never leave a task in steps 1 and 2. Every count is combined in the task first, so a phrase that fills a
third of the corpus is one row a task. Scores are taken from the counts by joins over distinct phrases.

Defined cases: a null text counts as empty and has no words; a null language is ``und``, together with rows
of that name. Rows with a null id, repeated rows and ties are documents like any other. An empty table gives
no rows. Columns but text and lang are not looked at. A word of any length is a word. Counts up to 10**16 are exact.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.broadcast import Broadcast
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tallyfold.llm.words import LOWER, hashed_words, mixed, slices, text_buffers
from tallyfold.session import materialize

LEAST, LONGEST, KEPT = 10, 3, 2000
#: Shards of which each is mined by itself; at most 15, and below LEAST so that the local support prunes.
SHARDS = 4
#: Two phrases of 100 in the longer one: the shorter is then no collocation of its own.
INSIDE = (50, 100)
#: Parts per whole of a score.
SCALE = 1_000_000
#: Bits of the filter for each candidate, and at most: 64 MB.
BITS_EACH, MOST_BITS = 16, 1 << 29
#: Bytes of text whose phrases a task counts at once.
AT_ONCE = 1 << 20
#: Counts that a task gathers before it adds them up, and rows that it gives to Spark at once.
GATHERED, EMITTED = 1 << 20, 1 << 16
#: Lists of the best that are made for each language before they are united.
TOP_PARTS = 64

_BYTES = np.arange(256)
_ENDS = np.isin(_BYTES, list(b".,;:!?\n\x0b\x0c\r"))
_WORD = ~(_ENDS | (_BYTES == 32) | (_BYTES == 9))
_LOWER = LOWER.astype(np.uint8)
_STEP = np.uint64(0x9E3779B97F4A7C15)
#: The low bits of a key hold the shard, from 1 on; 0 stands for any.
_SHARD_BITS = np.uint64(15)
_TURNS = (0x2545F49, 0x19D699A5)


class _Run:
    """Words of a run of texts: hashes, bytes, and where phrases may lie."""

    def __init__(self, texts: pa.Array, langs: pa.Array) -> None:
        data, offsets = text_buffers(texts)
        self.data = data
        self.hashes, self.starts, self.ends, bounds = hashed_words(data, offsets, _WORD)
        self.text = np.repeat(np.arange(len(texts)), np.diff(bounds))
        # Rises at the end of each piece and each text: equal for two words only within a piece.
        self.place = np.searchsorted(np.flatnonzero(_ENDS[data]), self.starts) + self.text
        coded = langs.fill_null("und").dictionary_encode()
        self.langs = coded.dictionary
        self.lang = coded.indices.to_numpy(zero_copy_only=False)[self.text]
        seeds = [xxhash.xxh3_64_intdigest(x.as_py().encode()) for x in self.langs]
        self.keys = [mixed(self.hashes * _STEP + np.array(seeds, np.uint64)[self.lang])]

    def at(self, length: int) -> np.ndarray:
        """First words of all phrases of so many words."""
        n = len(self.place) - length + 1
        return np.flatnonzero(self.place[:max(n, 0)] == self.place[length - 1:])

    def key(self, length: int) -> np.ndarray:
        """A 64-bit hash of the phrase and its language that begins at each word, its low bits free."""
        while len(self.keys) < length:
            last, n = self.keys[-1], len(self.hashes) - len(self.keys)
            self.keys.append(mixed(last[:max(n, 0)] * _STEP + self.hashes[len(self.keys):]))
        return self.keys[length - 1] & ~_SHARD_BITS


def _spots(key: np.ndarray, bits: int) -> tuple[np.ndarray, np.ndarray]:
    shard = key & _SHARD_BITS
    low = (key >> np.uint64(4)) ^ (shard * np.uint64(_TURNS[0]))
    high = (key >> np.uint64(34)) ^ (shard * np.uint64(_TURNS[1]))
    return low & np.uint64(bits - 1), high & np.uint64(bits - 1)


def _spot_columns(key: Column, bits: int) -> list[Column]:
    """The places of ``_spots`` as columns."""
    shard = key.bitwiseAND(F.lit(15))
    return [
        F.shiftrightunsigned(key, by).bitwiseXOR(shard * F.lit(turn)).bitwiseAND(F.lit(bits - 1))
        for by, turn in zip((4, 34), _TURNS, strict=True)]


class _Filter:
    """A bit filter over keys, built by Spark and sent to all tasks; at most MOST_BITS."""

    def __init__(self, keys: DataFrame) -> None:
        self.bits = 1 << 15
        wanted = min(keys.count() * BITS_EACH, MOST_BITS)
        while self.bits < wanted:
            self.bits *= 2
        places = keys.select(F.explode(F.array(*_spot_columns(F.col("key"), self.bits))).alias("at"))
        parts = places.groupBy(F.shiftright("at", 15).alias("part")).agg(
            F.bitmap_construct_agg(F.col("at").bitwiseAND(F.lit((1 << 15) - 1))).alias("bitmap"))
        flat = bytearray(self.bits // 8)
        for part, bitmap in parts.toLocalIterator():
            flat[part << 12:(part + 1) << 12] = bitmap
        self.sent: Broadcast = keys.sparkSession.sparkContext.broadcast(bytes(flat))

    def passes(self, key: np.ndarray) -> np.ndarray:
        flat = np.frombuffer(self.sent.value, np.uint8)
        one, other = _spots(key, self.bits)
        return ((flat[one >> np.uint64(3)] >> (one & np.uint64(7)).astype(np.uint8))
                & (flat[other >> np.uint64(3)] >> (other & np.uint64(7)).astype(np.uint8)) & 1).astype(bool)


def _runs(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[pa.RecordBatch, _Run]]:
    for batch in batches:
        for part in slices(batch.column(0), AT_ONCE):
            rows = batch.slice(part.start, part.stop - part.start)
            yield rows, _Run(rows.column(0), rows.column(1))


def _added(held: list[tuple[np.ndarray, np.ndarray]]) -> Iterator[pa.RecordBatch]:
    """The counts of several runs added up, in batches of bounded size."""
    if not held:
        return
    key, n = (np.concatenate(x) for x in zip(*held, strict=True))
    order = np.argsort(key)
    key, n = key[order], n[order]
    first = np.flatnonzero(np.append(True, key[1:] != key[:-1])) if len(key) else np.empty(0, np.int64)
    key, n = key[first].view(np.int64), np.add.reduceat(n, first) if len(first) else n
    for at in range(0, len(key), EMITTED):
        part = slice(at, at + EMITTED)
        yield pa.RecordBatch.from_arrays([pa.array(key[part]), pa.array(n[part], pa.int64())], names=["key", "n"])


def _mined(docs: DataFrame, lengths: list[int], shorter: _Filter | None, support: int) -> DataFrame:
    """Keys of the phrases of these lengths that one shard holds often enough; the shard in the low bits."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple[np.ndarray, np.ndarray]] = []
        for rows, words in _runs(batches):
            shard = rows.column(2).to_numpy().astype(np.uint64)[words.text]
            for length in lengths:
                at = words.at(length)
                if shorter is not None:
                    known = shorter.passes(words.key(length - 1) | shard[:len(words.key(length - 1))])
                    at = at[known[at] & known[at + 1]]
                held.append(np.unique(words.key(length)[at] | shard[at], return_counts=True))
            if sum(len(key) for key, _ in held) >= GATHERED:
                yield from _added(held)
                held = []
        yield from _added(held)

    counted = docs.mapInArrow(run, "key bigint, n bigint").groupBy("key").agg(F.sum("n").alias("n"))
    return counted.filter(F.col("n") >= support).select("key")


def _counted(docs: DataFrame, candidates: _Filter, longest: int) -> DataFrame:
    """lang, size, phrase, a: the exact count of every phrase that passes; size 0: all words of the language."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for _, words in _runs(batches):
            inside = _WORD[words.data]
            bounds = np.concatenate(([0], np.cumsum(words.ends - words.starts)))
            spelt = pa.LargeStringArray.from_buffers(
                len(words.starts), pa.py_buffer(bounds), pa.py_buffer(_LOWER[words.data[inside]])
            ).dictionary_encode()
            number = spelt.indices.to_numpy().astype(np.int64)
            total = np.bincount(words.lang, minlength=len(words.langs))
            yield _batch(words.langs, 0, pa.nulls(len(total), pa.string()), total)
            for length in range(1, longest + 1):
                at = words.at(length)
                at = at[candidates.passes(words.key(length)[at])]
                # Numbers of the phrases by their words themselves, not by a hash of them.
                code = words.lang[at].astype(np.int64)
                for i in range(length):
                    _, code = np.unique(code * len(spelt.dictionary) + number[at + i], return_inverse=True)
                _, first, n = np.unique(code, return_index=True, return_counts=True)
                first = at[first]
                parts = [spelt.dictionary.take(pa.array(number[first + i])) for i in range(length)]
                phrase = pc.binary_join_element_wise(*parts, pa.scalar(" ", pa.large_string()))
                yield _batch(words.langs.take(pa.array(words.lang[first])), length, phrase.cast(pa.string()), n)

    counted = docs.mapInArrow(run, "lang string, size int, phrase string, a bigint")
    return counted.groupBy("lang", "size", "phrase").agg(F.sum("a").alias("a"))


def _batch(lang: pa.Array, size: int, phrase: pa.Array, n: np.ndarray) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [lang, pa.array(np.full(len(n), size, np.int32)), phrase, pa.array(n, pa.int64())],
        names=["lang", "size", "phrase", "a"])


def phrase_counts(
    docs: DataFrame, least: int = LEAST, longest: int = LONGEST, shards: int = SHARDS
) -> DataFrame:
    """lang, size (words), phrase, a: all phrases of up to ``longest`` words found ``least`` times or more.

    A row of size 0 and no phrase holds the number of all words of the language.
    """
    if not 1 <= shards <= 15:
        raise ValueError("1 to 15 shards")
    support = (least - 1) // shards + 1
    texts = docs.select(
        F.coalesce("text", F.lit("")).alias("text"), "lang",
        (F.pmod(F.xxhash64("text"), F.lit(shards)) + 1).cast("int").alias("shard"))
    mined = [materialize(_mined(texts, [1, 2][:longest], None, support), "mined")]
    for length in range(3, longest + 1):
        mined.append(materialize(_mined(texts, [length], _Filter(mined[-1]), support), "mined"))
    anywhere = F.col("key").bitwiseAND(F.lit(-16)).alias("key")
    every = mined[0]
    for further in mined[1:]:
        every = every.union(further)
    candidates = _Filter(every.select(anywhere).distinct())
    counts = _counted(texts.select("text", "lang"), candidates, longest)
    return materialize(counts.filter((F.col("size") == 0) | (F.col("a") >= least)), "phrases")


def collocations(
    docs: DataFrame, least: int = LEAST, longest: int = LONGEST, keep: int = KEPT,
    shards: int = SHARDS, inside: tuple[int, int] = INSIDE,
) -> DataFrame:
    """lang, rank, phrase, a, l, r, n, score: the ``keep`` best collocations of each language.

    A phrase of two words or more, found a times, is cut in two where floor(SCALE * a * a / (l * r)) is least, l
    and r being the counts of its parts. It is left out if a longer one that holds it is found in at least
    ``inside`` of its places.
    """
    counts = phrase_counts(docs, least, longest, shards)
    words = F.split("phrase", " ", -1)
    phrases = counts.filter("size > 0")
    longer = counts.filter("size > 1")
    cut = longer.withColumn("w", words).withColumn("k", F.explode(F.sequence(F.lit(1), F.col("size") - 1)))
    cut = cut.select(
        "lang", "phrase", "a", "k", F.array_join(F.slice("w", F.lit(1), F.col("k")), " ").alias("left"),
        F.array_join(F.slice("w", F.col("k") + 1, F.col("size") - F.col("k")), " ").alias("right"))
    cut = cut.join(phrases.select("lang", F.col("phrase").alias("left"), F.col("a").alias("l")), ["lang", "left"])
    cut = cut.join(phrases.select("lang", F.col("phrase").alias("right"), F.col("a").alias("r")), ["lang", "right"])
    scored = cut.groupBy("lang", "phrase").agg(
        F.first("a").alias("a"), F.min(F.struct(_score("a", "l", "r").alias("score"), "k", "l", "r")).alias("cut"))
    # Each phrase's contiguous parts of two words or more, but itself.
    held = longer.filter("size > 2").withColumn("w", words).withColumn(
        "part", F.explode(F.sequence(F.lit(2), F.col("size") - 1))).withColumn(
        "from", F.explode(F.sequence(F.lit(1), F.col("size") - F.col("part") + 1)))
    held = held.select(
        "lang", F.array_join(F.slice("w", F.col("from"), F.col("part")), " ").alias("phrase"), "a")
    held = held.groupBy("lang", "phrase").agg(F.max("a").alias("most"))
    share, of = inside
    own = scored.join(held, ["lang", "phrase"], "left").filter(
        F.col("most").isNull() | (F.col("most") * of < F.col("a") * share))
    listed = own.select("lang", "phrase", "a", "cut.*")
    best = [F.desc("score"), F.desc("a"), F.asc("phrase")]
    parts = Window.partitionBy("lang", F.pmod(F.xxhash64("phrase"), F.lit(TOP_PARTS))).orderBy(*best)
    listed = listed.withColumn("rank", F.row_number().over(parts)).filter(F.col("rank") <= keep)
    whole = Window.partitionBy("lang").orderBy(*best)
    listed = listed.withColumn("rank", F.row_number().over(whole)).filter(F.col("rank") <= keep)
    totals = counts.filter("size = 0").select("lang", F.col("a").alias("n"))
    return listed.join(totals, "lang").select(
        "lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "l", "r", "n", "score")


def _score(a: str, left: str, right: str) -> Column:
    """floor(SCALE * a * a / (l * r)), exactly."""
    whole = "decimal(16,0)"
    above = f"cast({SCALE} * (cast({a} as {whole}) * cast({a} as {whole})) as decimal(38,0))"
    below = f"cast(cast({left} as {whole}) * cast({right} as {whole}) as decimal(38,0))"
    return F.expr(f"cast(({above}) div ({below}) as bigint)")
