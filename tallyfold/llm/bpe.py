"""Byte-level BPE by an index of pair occurrences.

A text is cut into pieces by the tokenizer's pattern; merges never cross a piece, and equal
pieces have equal tokens. So the distinct pieces met in a run of texts are laid end to end, with
a wall after each; every pair of neighbouring symbols that has a rank is listed with all its positions, and the ranks that occur
are applied in ascending order: one step merges all positions of a pair at once and lists the new
pairs at both sides of them. A pair can only come into being by a merge of a lower rank, so each rank is applied
once.

Defined cases: null counts as empty; an empty text has no tokens and decodes to an empty text.
Strings of special tokens in a text are special tokens, as in the library's default. Ids that
are no tokens are left out when decoding, and bytes that are no UTF-8 become U+FFFD.
"""

from __future__ import annotations

import functools
import heapq
import itertools
import json
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import regex
from pyspark import SparkFiles
from pyspark.sql import DataFrame
from pyspark.sql.types import StructType
from tokenizers import Tokenizer

from tallyfold.llm.frames import room_for
from tallyfold.llm.words import slices

#: The pattern that cuts a text into pieces, and the characters it takes as white space.
WHITE = "\t-\r \x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000"
PIECES = (
    r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
)
#: White space and what follows it up to the next white space: no piece reaches out of such a unit.
UNIT = re.compile(f"[{WHITE}]*[^{WHITE}]+|[{WHITE}]+")
#: From this character on, versions of Unicode differ in what a letter is: the library cuts then.
UNSETTLED = re.compile("[\u0530-\U0010ffff]")
#: Longer texts are cut, at a change from other characters to white space, before the pattern runs.
STRETCH = 1 << 18
#: Distinct units whose tokens a Python process keeps; beyond that it starts anew.
KEPT = 1 << 18
#: Bytes of text for which pieces are gathered before their merges run.
GATHERED = 4 << 20
#: Symbol of a position that is merged away, and of the walls between pieces.
GONE = -1
#: Up to so many positions of a pair are merged one by one.
FEW = 6
#: Positions whose first pairs are looked up at once.
BLOCK = 1 << 19


def _byte_symbols() -> dict[str, int]:
    """The printable character that stands for each byte in the vocabulary file."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    others = [b for b in range(256) if b not in plain]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(others)}


class Vocabulary:
    """Merges by rank and the bytes of each token, from a tokenizer file's text."""

    def __init__(self, content: str) -> None:
        spec = json.loads(content)
        byte_of = _byte_symbols()
        vocab: dict[str, int] = spec["model"]["vocab"]
        self.special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        self.bytes = [b""] * (max([*vocab.values(), *self.special.values()]) + 1)
        for token, i in vocab.items():
            if token not in self.special:
                self.bytes[i] = bytes(byte_of[c] for c in token)
        for token, i in self.special.items():
            self.bytes[i] = token.encode()
        self.first = np.array([vocab[c] for c, _ in sorted(byte_of.items(), key=lambda x: x[1])], np.int32)
        merges = [m.split(" ") if isinstance(m, str) else m for m in spec["model"]["merges"]]
        self.left = [vocab[a] for a, _ in merges]
        self.right = [vocab[b] for _, b in merges]
        self.made = [vocab[a + b] for a, b in merges]
        keys = np.array(self.left, np.int64) << 32 | np.array(self.right, np.int64)
        # A pair listed twice has its first rank.
        self.pairs, self.ranks = np.unique(keys, return_index=True)
        self.rank = dict(zip(self.pairs.tolist(), self.ranks.tolist(), strict=True))
        names = sorted(self.special, key=len, reverse=True)
        self.cut = regex.compile("|".join(map(regex.escape, names))) if names else None
        self.pattern = regex.compile(PIECES)
        self.library = Tokenizer.from_str(content).pre_tokenizer
        self.sizes = np.fromiter(map(len, self.bytes), np.int64, len(self.bytes))
        self.ends = np.cumsum(self.sizes)
        self.flat = np.frombuffer(b"".join(self.bytes), np.uint8)

    def pieces(self, unit: str) -> list[str]:
        """The pieces of a unit."""
        if UNSETTLED.search(unit):
            return [unit[i:j] for _, (i, j) in self.library.pre_tokenize_str(unit)]
        return self.pattern.findall(unit)

    def merge(self, pieces: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """Tokens of all pieces end to end, and where each piece begins (and the last ends)."""
        laid = np.frombuffer(b"\0" + b"\0".join(pieces) + b"\0", np.uint8)
        lengths = np.fromiter(map(len, pieces), np.int64, len(pieces))
        walls = np.concatenate(([0], np.cumsum(lengths + 1)))
        symbols = self.first[laid]
        symbols[walls] = GONE  # a wall between pieces has no rank with anything
        n = len(symbols)
        following = np.arange(1, n + 1, dtype=np.int32)
        previous = np.arange(-1, n - 1, dtype=np.int32)
        many: dict[int, list[np.ndarray]] = {}
        few: dict[int, list[int]] = {}
        active: list[int] = []

        def note(rank: int, at: int) -> None:
            if rank in few:
                few[rank].append(at)
            else:
                few[rank] = [at]
                if rank not in many:
                    heapq.heappush(active, rank)

        def listed(left: np.ndarray) -> None:
            """Adds the pairs that begin at these positions to the index."""
            keys = symbols[left].astype(np.int64) << 32 | symbols[following[left]]
            at = np.searchsorted(self.pairs, keys)
            at[at == len(self.pairs)] = 0
            some = np.flatnonzero(self.pairs[at] == keys)
            if not len(some):
                return
            rank, left = self.ranks[at[some]], left[some]
            order = np.argsort(rank, kind="stable")
            rank, left = rank[order], left[order]
            edges = [0, *(np.flatnonzero(rank[1:] != rank[:-1]) + 1).tolist(), len(rank)]
            for r, i, j in zip(rank[edges[:-1]].tolist(), edges, edges[1:], strict=False):
                if j - i <= FEW:
                    for x in left[i:j].tolist():
                        note(r, x)
                elif r in many:
                    many[r].append(left[i:j])
                else:
                    many[r] = [left[i:j]]
                    if r not in few:
                        heapq.heappush(active, r)

        for start in range(1, n - 1, BLOCK):
            listed(np.arange(start, min(start + BLOCK, n - 1), dtype=np.int32))
        rank_of = self.rank.get
        while active:
            rank = heapq.heappop(active)
            a, b, made = self.left[rank], self.right[rank], self.made[rank]
            if rank not in many and len(few[rank]) <= FEW:
                for i in sorted(few.pop(rank)):
                    # A position whose pair has meanwhile gone is stale.
                    if symbols[i] != a or symbols[j := int(following[i])] != b:
                        continue
                    k, h = int(following[j]), int(previous[i])
                    symbols[i], symbols[j] = made, GONE
                    following[i], previous[k] = k, i
                    if (r := rank_of(int(symbols[h]) << 32 | made)) is not None:
                        note(r, h)
                    if (r := rank_of(made << 32 | int(symbols[k]))) is not None:
                        note(r, i)
                continue
            at = np.concatenate([*many.pop(rank, []), np.array(few.pop(rank, []), np.int32)])
            at = at[symbols[at] == a]
            right = following[at]
            fresh = symbols[right] == b
            at, right = at[fresh], right[fresh]
            if a == b and len(at) > 1:
                # In a run of one symbol every second pair is taken, from the left.
                at = np.unique(at)
                right = following[at]
                place = np.arange(len(at))
                run = np.maximum.accumulate(np.where(np.append(True, right[:-1] != at[1:]), place, 0))
                even = (place - run) % 2 == 0
                at, right = at[even], right[even]
            if not len(at):
                continue
            beyond = following[right]
            symbols[at], symbols[right] = made, GONE
            following[at], previous[beyond] = beyond, at
            before = previous[at]
            listed(at)
            # Where two merges meet, the pair between them was listed as the left one's.
            listed(before[symbols[before] != made])
        counted = np.concatenate(([0], np.cumsum(symbols != GONE)))
        return symbols[symbols != GONE], counted[walls]


def stretches(text: str, most: int = STRETCH) -> Iterator[str]:
    """The text in parts, cut only where white space follows another character.

    The pattern always begins a piece there, so the pieces are those of the whole text.
    """
    at = 0
    cut = re.compile(f"[^{WHITE}](?=[{WHITE}])")
    while len(text) - at > most:
        found = cut.search(text, at + most - 1)
        if not found:
            break
        yield text[at:found.end()]
        at = found.end()
    yield text[at:] if at else text


class _Numbers(dict):
    """Numbers keys in the order in which they are first looked up."""

    def __missing__(self, key: str) -> int:
        self[key] = number = len(self)
        return number


class Encoder:
    """Encodes texts; keeps the tokens of units met before, up to ``kept`` of them."""

    def __init__(self, vocab: Vocabulary, kept: int = KEPT) -> None:
        self.vocab, self.kept = vocab, kept
        self.clear()

    def clear(self) -> None:
        # A special token's string is never part of an ordinary unit, so both share the numbers.
        self.number = _Numbers({name: i for i, name in enumerate(self.vocab.special)})
        self.tokens = np.array([*self.vocab.special.values()], np.int32)
        self.bounds = np.arange(len(self.tokens) + 1)

    def _units(self, text: str) -> Iterator[list[str]]:
        special = self.vocab.special
        if any(name in text for name in special):
            at = 0
            for found in self.vocab.cut.finditer(text):
                yield from map(UNIT.findall, stretches(text[at:found.start()]))
                yield [found.group()]
                at = found.end()
            text = text[at:]
        yield from map(UNIT.findall, stretches(text))

    def encode(self, texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts end to end, and where each text's begin (and the last's end)."""
        if len(self.number) > self.kept:
            self.clear()
        known, numbers, counts = len(self.number), [], []
        for text in texts:
            mine = [
                np.fromiter(map(self.number.__getitem__, units), np.int32, len(units))
                for units in self._units(text or "")
            ]
            numbers += mine
            counts.append(sum(map(len, mine)))
        if len(self.number) > known:
            self._learn(list(itertools.islice(self.number, known, None)))
        units = np.concatenate([np.empty(0, np.int32), *numbers])
        lengths = self.bounds[units + 1] - self.bounds[units]
        upto = np.concatenate(([0], np.cumsum(lengths)))
        ids = np.empty(upto[-1], np.int32)
        for i in range(0, len(units), BLOCK):
            part = slice(i, i + BLOCK)
            shift = self.bounds[units[part]] - upto[:-1][part]
            low, high = upto[i], upto[min(i + BLOCK, len(units))]
            ids[low:high] = self.tokens[np.repeat(shift, lengths[part]) + np.arange(low, high)]
        return ids, upto[np.concatenate(([0], np.cumsum(counts, dtype=np.int64)))]

    def _learn(self, units: list[str]) -> None:
        pieces, counts = [], []
        for unit in units:
            cut = self.vocab.pieces(unit)
            pieces += [p.encode() for p in cut]
            counts.append(len(cut))
        tokens, bounds = self.vocab.merge(pieces)
        self.bounds = np.concatenate((self.bounds, bounds[np.cumsum(counts)] + len(self.tokens)))
        self.tokens = np.concatenate((self.tokens, tokens))


def decoded(vocab: Vocabulary, ids: np.ndarray) -> str:
    """The text of an array of ids, special tokens as their strings."""
    parts = []
    for i in range(0, len(ids), BLOCK):
        some = ids[i:i + BLOCK]
        some = some[(some >= 0) & (some < len(vocab.sizes))]
        sizes, ends = vocab.sizes[some], vocab.ends[some]
        upto = np.cumsum(sizes)
        if len(some):
            parts.append(vocab.flat[np.repeat(ends - upto, sizes) + np.arange(upto[-1])].tobytes())
    return b"".join(parts).decode("utf-8", "replace")


@functools.lru_cache(maxsize=2)
def encoder(file: str) -> Encoder:
    """For a file given to ``SparkContext.addFile``: one for all tasks of a Python process."""
    with open(SparkFiles.get(file), encoding="utf-8") as f:
        return Encoder(Vocabulary(f.read()))


def _shared(df: DataFrame, path: str) -> str:
    """Sends the vocabulary file (a fixed size) to every executor; returns its name there."""
    df.sparkSession.sparkContext.addFile(path)
    return path.rsplit("/", 1)[-1]


def encode(df: DataFrame, tokenizer: str, text: str = "text", ids: str = "ids") -> DataFrame:
    """Adds the list of token ids of a text column. ``tokenizer``: path of the vocabulary file."""
    file = _shared(df, tokenizer)
    kept, schema = room_for(df, f"{ids} array<int>")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            column = batch.column(batch.schema.get_field_index(text))
            for part in slices(column, GATHERED):
                flat, bounds = encoder(file).encode(column[part].to_pylist())
                rows = batch.slice(part.start, part.stop - part.start)
                lists = pa.ListArray.from_arrays(pa.array(bounds, pa.int32()), pa.array(flat))
                yield pa.RecordBatch.from_arrays(
                    [*rows.columns, lists], names=[*batch.schema.names, ids])

    return kept.mapInArrow(run, schema)


def round_trip(
    df: DataFrame, tokenizer: str, text: str = "text", ids: str = "ids", again: str = "decoded"
) -> DataFrame:
    """``encode`` and ``decode`` in one pass: replaces the text by its ids and what they decode to."""
    file = _shared(df, tokenizer)
    df, schema = room_for(df, f"{ids} array<int>, {again} string")
    kept = [name for name in df.columns if name != text]
    schema = StructType([f for f in schema.fields if f.name != text])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            column = batch.column(batch.schema.get_field_index(text))
            for part in slices(column, GATHERED):
                flat, bounds = encoder(file).encode(column[part].to_pylist())
                made = [decoded(encoder(file).vocab, flat[i:j])
                        for i, j in zip(bounds[:-1].tolist(), bounds[1:].tolist(), strict=True)]
                rows = batch.slice(part.start, part.stop - part.start).select(kept)
                lists = pa.ListArray.from_arrays(pa.array(bounds, pa.int32()), pa.array(flat))
                yield pa.RecordBatch.from_arrays(
                    [*rows.columns, lists, pa.array(made, pa.string())], names=[*kept, ids, again])

    return df.mapInArrow(run, schema)


def decode(df: DataFrame, tokenizer: str, ids: str = "ids", text: str = "decoded") -> DataFrame:
    """Adds the text of a column of ids; null ids give null."""
    file = _shared(df, tokenizer)
    kept, schema = room_for(df, f"{text} string")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            vocab = encoder(file).vocab
            made = pa.array([
                decoded(vocab, x.values.fill_null(-1).to_numpy()) if x.is_valid else None
                for x in batch.column(batch.schema.get_field_index(ids))], pa.string())
            yield pa.RecordBatch.from_arrays([*batch.columns, made], names=[*batch.schema.names, text])

    return kept.mapInArrow(run, schema)
