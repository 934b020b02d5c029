"""Quality scores by a generalised additive model with pairwise interactions.

Each text gives a few numbers about its characters, words and repetitions. The model adds a constant,
a value from a table over the bins of each number, and a value from a grid for some pairs of them;
the logistic function of the sum is the score. Tables are learnt by cyclic boosting: shallow trees on one
number after the other, round by round, each with a small step; then trees on the chosen pairs.

The fit uses a sample of labelled rows that is bounded by a parameter and travels to the driver
as numbers, never as texts. Scoring looks up bins and adds; every text is measured whole.

Defined cases: null and empty texts have all numbers 0 and are scored like any other. Labels that
are null are not used; without any label, or with one kind only, every score is the share of
label 1 (0.5 without any). Repeated rows count as often as they stand.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType

from tallyfold.llm.frames import bounded_sample, room_for
from tallyfold.llm.words import SPACED_BYTES, hashed_words, mixed, slices, text_buffers

FEATURES = (
    "log_words", "word_length", "upper", "digits", "symbols", "stops", "shouts", "bars", "line_words",
    "distinct_words", "distinct_pairs", "distinct_triples", "repeated_next", "top_word",
)
#: Labelled rows that a fit takes at most.
SAMPLE = 30_000
BINS, PAIR_BINS = 48, 12
ROUNDS, PAIR_ROUNDS, PAIRS = 160, 60, 8
LEAVES, STEP, PENALTY, LEAST_ROWS = 4, 0.1, 2.0, 8
AT_ONCE = 1 << 20

_SETS = {
    "upper": b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", "lower": b"abcdefghijklmnopqrstuvwxyz", "digits": b"0123456789",
    "symbols": b"#$%&*+<=>@^_`{}~\\", "stops": b".,;:", "shouts": b"!?", "bars": b"|", "lines": b"\n",
    "blanks": b" \t\n\r\v\f",
}
_CLASSES = np.array([[b in chars for chars in _SETS.values()] for b in range(256)], np.int64)


def measures(column: pa.Array) -> np.ndarray:
    """A row of ``FEATURES`` for each text."""
    out = [_measured(column[part]) for part in slices(column, AT_ONCE)]
    return np.concatenate(out) if out else np.empty((0, len(FEATURES)))


def _measured(column: pa.Array) -> np.ndarray:
    data, offsets = text_buffers(column)
    hashes, _, _, bounds = hashed_words(data, offsets, SPACED_BYTES)
    out = np.zeros((len(column), len(FEATURES)))
    for row, (i, j, a, b) in enumerate(zip(
        offsets[:-1].tolist(), offsets[1:].tolist(), bounds[:-1].tolist(), bounds[1:].tolist(), strict=True)):
        if a == b:
            continue
        seen = dict(zip(_SETS, (np.bincount(data[i:j], minlength=256) @ _CLASSES).tolist(), strict=True))
        words, n, size = hashes[a:b], b - a, j - i
        letters = max(seen["upper"] + seen["lower"], 1)
        shown = max(size - seen["blanks"], 1)
        ordered = np.sort(words)
        first = np.flatnonzero(np.append(True, ordered[1:] != ordered[:-1]))
        pairs = mixed(words[:-1] * np.uint64(3)) + words[1:]
        triples = mixed(pairs[:-1]) + words[2:]
        out[row] = (
            np.log1p(n), shown / n, seen["upper"] / letters, seen["digits"] / shown,
            seen["symbols"] / shown, seen["stops"] / n, seen["shouts"] / n, seen["bars"] / n,
            np.log1p(n / (seen["lines"] + 1)), len(first) / n, _distinct_share(pairs),
            _distinct_share(triples), np.count_nonzero(words[1:] == words[:-1]) / n,
            np.diff(np.append(first, n)).max() / n,
        )
    return out


def _distinct_share(values: np.ndarray) -> float:
    if not len(values):
        return 1.0
    ordered = np.sort(values)
    return (np.count_nonzero(ordered[1:] != ordered[:-1]) + 1) / len(values)


@dataclass(frozen=True)
class Model:
    """A constant, a table over the bins of each number, and grids over the bins of pairs."""

    constant: float
    edges: list[np.ndarray]
    tables: list[np.ndarray]
    pairs: list[tuple[int, int]]
    pair_edges: list[np.ndarray]
    grids: list[np.ndarray]

    def scores(self, values: np.ndarray) -> np.ndarray:
        total = np.full(len(values), self.constant)
        for j, (edges, table) in enumerate(zip(self.edges, self.tables, strict=True)):
            total += table[np.searchsorted(edges, values[:, j], side="right")]
        for (j, k), grid in zip(self.pairs, self.grids, strict=True):
            total += grid[
                np.searchsorted(self.pair_edges[j], values[:, j], side="right"),
                np.searchsorted(self.pair_edges[k], values[:, k], side="right")]
        return 1 / (1 + np.exp(-total))


def _edges(values: np.ndarray, bins: int) -> np.ndarray:
    """Bounds between bins of about equal counts."""
    return np.unique(np.quantile(values, np.linspace(0, 1, bins + 1)[1:-1]))


def _tree(slope: np.ndarray, weight: np.ndarray, rows: np.ndarray, leaves: int) -> np.ndarray:
    """Values of a tree of a few leaves over ordered bins, given sums of each bin."""
    out = np.zeros(len(slope))
    g, h, n = (np.concatenate(([0], np.cumsum(x))) for x in (slope, weight, rows))
    spans = [(0, len(slope))]

    def best(i: int, j: int) -> tuple[float, int]:
        cut = np.arange(i + 1, j)
        left, right = g[cut] - g[i], g[j] - g[cut]
        gain = left**2 / (h[cut] - h[i] + PENALTY) + right**2 / (h[j] - h[cut] + PENALTY)
        gain[(n[cut] - n[i] < LEAST_ROWS) | (n[j] - n[cut] < LEAST_ROWS)] = -1
        if not len(gain):
            return -1.0, i
        at = int(np.argmax(gain))
        return float(gain[at] - (g[j] - g[i]) ** 2 / (h[j] - h[i] + PENALTY)), int(cut[at])

    while len(spans) < leaves:
        gain, cut, at = max((*best(i, j), at) for at, (i, j) in enumerate(spans))
        if gain <= 0:
            break
        i, j = spans.pop(at)
        spans += [(i, cut), (cut, j)]
    for i, j in spans:
        out[i:j] = (g[j] - g[i]) / (h[j] - h[i] + PENALTY)
    return out


def _grid_tree(slope: np.ndarray, weight: np.ndarray, rows: np.ndarray) -> tuple[np.ndarray, float]:
    """Values of a tree over a grid, one cut down and then one across each part, and its gain."""
    best_gain, best_out = 0.0, np.zeros(slope.shape)
    for turned in (False, True):
        g, h, n = (x.T if turned else x for x in (slope, weight, rows))
        for cut in range(1, g.shape[0]):
            out, gain = np.zeros(g.shape), 0.0
            for part in (slice(0, cut), slice(cut, None)):
                values = _tree(g[part].sum(0), h[part].sum(0), n[part].sum(0), 2)
                out[part] = values
                gain += float((values * g[part].sum(0)).sum())
            if gain > best_gain:
                best_gain, best_out = gain, (out.T if turned else out).copy()
    return best_out, best_gain


def fitted(values: np.ndarray, label: np.ndarray) -> Model:
    """The model for rows of ``FEATURES`` and labels 0 or 1."""
    width = values.shape[1]
    share = label.mean() if len(label) else 0.5
    if len(label) == 0 or share in (0, 1):
        edge = min(max(share, 1e-6), 1 - 1e-6)
        none = [np.empty(0)] * width
        return Model(float(np.log(edge / (1 - edge))), none, [np.zeros(1)] * width, [], none, [])
    constant = float(np.log(share / (1 - share)))
    edges = [_edges(values[:, j], BINS) for j in range(width)]
    bins = [np.searchsorted(edges[j], values[:, j], side="right") for j in range(width)]
    tables = [np.zeros(len(e) + 1) for e in edges]
    rows = [np.bincount(b, minlength=len(t)) for b, t in zip(bins, tables, strict=True)]
    total = np.full(len(label), constant)

    def slopes() -> tuple[np.ndarray, np.ndarray]:
        p = 1 / (1 + np.exp(-total))
        return label - p, p * (1 - p)

    for _ in range(ROUNDS):
        for j in range(width):
            slope, weight = slopes()
            size = len(tables[j])
            change = STEP * _tree(
                np.bincount(bins[j], slope, size), np.bincount(bins[j], weight, size), rows[j], LEAVES)
            tables[j] += change
            total += change[bins[j]]

    pair_edges = [_edges(values[:, j], PAIR_BINS) for j in range(width)]
    coarse = [np.searchsorted(pair_edges[j], values[:, j], side="right") for j in range(width)]

    def cells(j: int, k: int) -> tuple[np.ndarray, tuple[int, int]]:
        shape = (len(pair_edges[j]) + 1, len(pair_edges[k]) + 1)
        return coarse[j] * shape[1] + coarse[k], shape

    def grown(j: int, k: int) -> tuple[np.ndarray, float, np.ndarray]:
        at, shape = cells(j, k)
        slope, weight = slopes()
        sums = [np.bincount(at, x, shape[0] * shape[1]).reshape(shape) for x in (slope, weight, None)]
        return (*_grid_tree(*sums), at)

    ranked = sorted(
        ((grown(j, k)[1], j, k) for j in range(width) for k in range(j + 1, width)), reverse=True)
    pairs = [(j, k) for gain, j, k in ranked[:PAIRS] if gain > 0]
    grids = [np.zeros(cells(j, k)[1]) for j, k in pairs]
    for _ in range(PAIR_ROUNDS):
        for i, (j, k) in enumerate(pairs):
            change, _, at = grown(j, k)
            grids[i] += STEP * change
            total += STEP * change.ravel()[at]
    return Model(constant, edges, tables, pairs, pair_edges, grids)


def with_features(docs: DataFrame, text: str = "text", name: str = "features") -> DataFrame:
    """Adds the numbers of each text as array<double>."""
    kept, schema = room_for(docs, f"{name} array<double>")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            made = measures(batch.column(batch.schema.get_field_index(text)))
            bounds = np.arange(len(made) + 1, dtype=np.int32) * len(FEATURES)
            lists = pa.ListArray.from_arrays(pa.array(bounds), pa.array(made.ravel()))
            yield pa.RecordBatch.from_arrays([*batch.columns, lists], names=[*batch.schema.names, name])

    return kept.mapInArrow(run, schema)


def rated(docs: DataFrame, model: Model, text: str = "text", name: str = "score") -> DataFrame:
    """Adds the score of each text, measured and scored in one pass of one worker a task."""
    kept, schema = room_for(docs, f"{name} double")
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            column = batch.column(batch.schema.get_field_index(text))
            for part in slices(column, AT_ONCE):
                rows = batch.slice(part.start, part.stop - part.start)
                scores = shared.value.scores(measures(column[part]))
                yield pa.RecordBatch.from_arrays(
                    [*rows.columns, pa.array(scores)], names=[*batch.schema.names, name])

    return kept.mapInArrow(run, schema)


def held_out(doc_id: Column | str) -> Column:
    """Whether a row is kept out of every fit; a row without id is not."""
    id_ = F.col(doc_id) if isinstance(doc_id, str) else doc_id
    return F.coalesce(F.crc32(id_.cast("string")) % 5 == 0, F.lit(False))


def train(measured: DataFrame, labels: DataFrame, target: str = "quality", sample: int = SAMPLE) -> Model:
    """A model from rows (doc_id, features) with a label that are not held out, ``sample`` at most.

    A larger number of labelled rows is cut by a hash of their id, so which rows take part does not
    depend on how they are stored.
    """
    labelled = labels.filter(F.col(target).isNotNull() & ~held_out("doc_id")).select("doc_id", F.col(target).alias("_label"))
    rows = bounded_sample(
        measured.select("doc_id", "features").join(labelled, "doc_id"), sample, "doc_id", "_label", "features"
    ).toPandas()
    if not len(rows):
        return fitted(np.empty((0, len(FEATURES))), np.empty(0))
    return fitted(np.stack(rows["features"].to_list()), rows["_label"].to_numpy(float))


def scored(
    measured: DataFrame, model: Model, name: str = "score", features: str = "features"
) -> DataFrame:
    """Adds the score of each row's features. The model's size is set by its bins and pairs."""
    shared = measured.sparkSession.sparkContext.broadcast(model)

    @F.pandas_udf(DoubleType())
    def score(values: pd.Series) -> pd.Series:
        return pd.Series(shared.value.scores(np.stack(values.to_list())) if len(values) else [], dtype=float)

    return measured.withColumn(name, score(features))
