"""Nearest neighbours by learned partitions.

The index is fitted on a bounded sample: its graph of nearest neighbours is cut into balanced parts
with few edges between them, and a small network learns, for a vector, how likely each part is to hold
its neighbours. Every row is put into its likeliest part. A query goes to its likeliest parts, as
many as the sample needs to find a stated share of its true neighbours, and their rows are ranked by the true distance.

Rows of a part are dealt into blocks, and so are its queries, both of bounded size by counting; a
block of queries meets each block of rows of its part once. So a part with a third of all rows
is as many tasks as it has blocks. The best of each meeting are merged per query.

Defined cases: vectors that are null, zero, or hold null or non-finite numbers take no part, nor do
those whose length is not the commonest one (the shorter, in a tie) or whose id is null. A query is never its own
candidate; with fewer than ``k`` others all are returned. Ties go to the smaller id.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tallyfold.llm.frames import bounded_sample
from tallyfold.session import materialize

#: Rows that the index is fitted on, at most; another such sample, disjoint, sets the probes.
SAMPLE, TRIALS = 8192, 512
PARTS, DEGREE, HIDDEN, EPOCHS = 32, 20, 96, 24
#: Share of true neighbours that the probed parts must hold in the trials.
TARGET = 0.94
ROW_BLOCK, QUERY_BLOCK = 8192, 1024


def usable(vectors: DataFrame, vec: str = "embedding") -> DataFrame:
    """vec_id and vec (array<double>) of the rows that take part."""
    finite = F.forall(vec, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    sized = vectors.filter(F.col("vec_id").isNotNull() & F.col(vec).isNotNull() & finite & F.exists(
        vec, lambda x: x != 0)).select("vec_id", F.col(vec).cast("array<double>").alias("vec"))
    lengths = sized.groupBy(F.size("vec").alias("n")).agg(F.count("*").alias("rows"))
    first = lengths.orderBy(F.desc("rows"), "n").first()
    return sized.filter(F.size("vec") == (first["n"] if first else 0))


def nearest_in(rows: np.ndarray, queries: np.ndarray, k: int, own: np.ndarray | None = None) -> np.ndarray:
    """Places of the k nearest rows of each query, in no order; ``own`` names a row to leave out."""
    norms = (rows**2).sum(1)
    out = np.empty((len(queries), k), np.int64)
    for i in range(0, len(queries), 512):
        far = norms - 2 * queries[i:i + 512] @ rows.T
        if own is not None:
            far[np.arange(len(far)), own[i:i + 512]] = np.inf
        out[i:i + 512] = np.argpartition(far, k - 1, axis=1)[:, :k]
    return out


def balanced_parts(rows: np.ndarray, graph: np.ndarray, parts: int, seed: int = 7) -> np.ndarray:
    """A part for each row: halves along main directions, then moves that cut fewer graph edges.

    A row moves to the part of most of its neighbours, if that gains edges and leaves all parts
    within a tenth of equal size; several rounds, in a fixed random order.
    """
    part = np.zeros(len(rows), np.int64)
    rng = np.random.default_rng(seed)
    for _ in range(int(math.log2(parts))):
        new = np.empty_like(part)
        for p in np.unique(part):
            at = np.flatnonzero(part == p)
            centred = rows[at] - rows[at].mean(0)
            direction = np.linalg.eigh(centred.T @ centred)[1][:, -1]
            half = np.argsort(np.argsort(centred @ direction, kind="stable"), kind="stable") >= len(at) // 2
            new[at] = 2 * p + half
        part = new
    around = [[] for _ in rows]
    for i, near in enumerate(graph.tolist()):
        for j in near:
            around[i].append(j)
            around[j].append(i)
    around = [np.array(a) for a in around]
    sizes = np.bincount(part, minlength=parts)
    low, high = 0.9 * len(rows) / parts, 1.1 * len(rows) / parts
    for _ in range(6):
        moved = 0
        for i in rng.permutation(len(rows)).tolist():
            votes = np.bincount(part[around[i]], minlength=parts)
            votes[sizes >= high] = -1
            best, mine = int(np.argmax(votes)), int(part[i])
            if best != mine and sizes[mine] > low and votes[best] > np.count_nonzero(part[around[i]] == mine):
                part[i] = best
                sizes[mine] -= 1
                sizes[best] += 1
                moved += 1
        if moved < len(rows) // 200:
            break
    return part


@dataclass(frozen=True)
class Router:
    """A network of one hidden layer that gives each part a probability."""

    centre: np.ndarray
    scale: float
    first: np.ndarray
    second: np.ndarray

    def _hidden(self, rows: np.ndarray) -> np.ndarray:
        x = (rows - self.centre) / self.scale
        return np.hstack([np.maximum(np.hstack([x, np.ones((len(x), 1))]) @ self.first, 0), x, np.ones((len(x), 1))])

    def logits(self, rows: np.ndarray) -> np.ndarray:
        return self._hidden(rows) @ self.second

    def ranked(self, rows: np.ndarray) -> np.ndarray:
        """Parts of each row, likeliest first."""
        return np.argsort(-self.logits(rows), axis=1, kind="stable")


def trained_router(rows: np.ndarray, wanted: np.ndarray, seed: int = 11) -> Router:
    """Learns the distribution ``wanted`` over parts of each row, by Adam on cross entropy."""
    rng = np.random.default_rng(seed)
    centre = rows.mean(0)
    scale = float((rows - centre).std()) or 1.0
    width, parts = rows.shape[1], wanted.shape[1]
    first = rng.normal(0, math.sqrt(2 / width), (width + 1, HIDDEN))
    second = np.zeros((HIDDEN + width + 1, parts))
    x = np.hstack([(rows - centre) / scale, np.ones((len(rows), 1))])
    state = [[np.zeros_like(w), np.zeros_like(w)] for w in (first, second)]
    step = 0
    for epoch in range(EPOCHS):
        rate = 4e-3 * (1 - epoch / EPOCHS) + 2e-4
        order = rng.permutation(len(rows))
        for i in range(0, len(rows), 256):
            at = order[i:i + 256]
            pre = x[at] @ first
            hidden = np.hstack([np.maximum(pre, 0), x[at]])
            out = hidden @ second
            out = np.exp(out - out.max(1, keepdims=True))
            slope = (out / out.sum(1, keepdims=True) - wanted[at]) / len(at)
            slopes = (x[at].T @ ((slope @ second[:HIDDEN].T) * (pre > 0)), hidden.T @ slope)
            step += 1
            for w, g, (m, v) in zip((first, second), slopes, state, strict=True):
                g = g + 1e-4 * w
                m += 0.1 * (g - m)
                v += 0.01 * (g * g - v)
                w -= rate * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.99**step)) + 1e-8)
    return Router(centre, scale, first, second)


def fitted(sample: np.ndarray, trials: np.ndarray, k: int, parts: int = PARTS, target: float = TARGET) -> tuple[Router, int]:
    """The router, and the number of parts that hold ``target`` of the trials' neighbours in the sample."""
    parts = min(parts, 1 << max(0, int(math.log2(max(len(sample) // 64, 1)))))
    if parts < 2:
        width = sample.shape[1] if len(sample) else 0
        return Router(np.zeros(width), 1.0, np.zeros((width + 1, HIDDEN)), np.zeros((HIDDEN + width + 1, 1))), 1
    graph = nearest_in(sample, sample, DEGREE, np.arange(len(sample)))
    part = balanced_parts(sample, graph, parts)
    wanted = np.zeros((len(sample), parts))
    np.add.at(wanted, (np.arange(len(sample)), part), 2.0)
    np.add.at(wanted, (np.repeat(np.arange(len(sample)), DEGREE), part[graph].ravel()), 1.0)
    wanted /= wanted.sum(1, keepdims=True)
    router = trained_router(sample, wanted)
    placed = router.ranked(sample)[:, 0]
    near = nearest_in(sample, trials, min(k, len(sample)))
    place_in_rank = np.argsort(router.ranked(trials), axis=1, kind="stable")
    need = np.take_along_axis(place_in_rank, placed[near], axis=1)
    found = np.array([(need < p).mean() for p in range(1, parts + 1)])
    return router, int(np.argmax(found >= target)) + 1


@dataclass(frozen=True)
class Index:
    """Every row with its part, the router, and the number of parts to probe."""

    rows: DataFrame
    router: Router
    probes: int


def _as_matrix(vectors: pd.Series, width: int) -> np.ndarray:
    return np.stack(vectors.to_list()).astype(float) if len(vectors) else np.empty((0, width))


def build_index(vectors: DataFrame, k: int = 10, vec: str = "embedding") -> Index:
    """Fits the router on a sample by hash of the id, and gives every row its part."""
    rows = usable(vectors, vec)
    drawn = bounded_sample(rows, SAMPLE + TRIALS, "vec_id", "vec").toPandas()
    matrix = _as_matrix(drawn["vec"], 0)
    trials = min(TRIALS, len(matrix) // 4)
    router, probes = fitted(matrix[trials:], matrix[:trials], k)
    shared = rows.sparkSession.sparkContext.broadcast(router)

    @F.pandas_udf("int")
    def part_of(vec: pd.Series) -> pd.Series:
        best = np.argmax(shared.value.logits(_as_matrix(vec, len(shared.value.centre))), axis=1)
        return pd.Series(best, dtype="int32")

    return Index(materialize(rows.withColumn("part", part_of("vec")), "parts"), router, probes)


def routed(index: Index, queries: DataFrame) -> DataFrame:
    """A row for each query and part to probe."""
    shared, probes = queries.sparkSession.sparkContext.broadcast(index.router), index.probes

    @F.pandas_udf("array<int>")
    def probed(vec: pd.Series) -> pd.Series:
        ranked = shared.value.ranked(_as_matrix(vec, len(shared.value.centre)))[:, :probes]
        return pd.Series(list(ranked.astype(np.int32)))

    return queries.withColumn("part", F.explode(probed("vec")))


def _dealt(rows: DataFrame, counts: dict[int, tuple[int, int]], mine: int) -> DataFrame:
    """Each row in one block of its kind, and in a copy for each block of the other kind."""
    def per_part(which: int) -> Column:
        pairs = [F.lit(x) for part, blocks in counts.items() for x in (part, blocks[which])]
        return F.coalesce(F.create_map(*pairs)[F.col("part")], F.lit(1)) if pairs else F.lit(1)

    names = ("row_block", "query_block")
    own = F.pmod(F.xxhash64("vec_id"), per_part(mine)).cast("int")
    return rows.withColumn(names[mine], own).withColumn(
        names[1 - mine], F.explode(F.sequence(F.lit(0), per_part(1 - mine) - 1)))


def search(index: Index, queries: DataFrame, k: int = 10) -> DataFrame:
    """query_id, rank, vec_id, score: the ``k`` nearest rows found for each query (vec_id, vec).

    The score is the Euclidean distance of the vectors as given, in double precision.
    """
    wanted = materialize(routed(index, queries.select("vec_id", "vec")), "routed")
    sizes = {
        name: {r["part"]: r["count"] for r in df.groupBy("part").count().collect()}
        for name, df in (("rows", index.rows), ("queries", wanted))
    }
    counts = {
        part: (math.ceil(n / ROW_BLOCK), math.ceil(sizes["queries"].get(part, 1) / QUERY_BLOCK))
        for part, n in sizes["rows"].items()
    }
    keys = ["part", "row_block", "query_block"]
    left = _dealt(index.rows, counts, 0).groupBy(*keys)
    right = _dealt(wanted, counts, 1).groupBy(*keys)

    def meet(rows: pd.DataFrame, asked: pd.DataFrame) -> pd.DataFrame:
        return best_of(rows, asked, k)

    found = left.cogroup(right).applyInPandas(meet, "query_id bigint, vec_id bigint, score double")
    order = Window.partitionBy("query_id").orderBy("score", "vec_id")
    return (
        found.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)
        .select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score")
    )


def best_of(rows: pd.DataFrame, asked: pd.DataFrame, k: int) -> pd.DataFrame:
    """The ``k`` nearest of some rows for each of some queries, by distance, then id."""
    out: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
    if len(rows) and len(asked):
        matrix, ids = _as_matrix(rows["vec"], 0), rows["vec_id"].to_numpy()
        norms = (matrix**2).sum(1)
        wanted, names = _as_matrix(asked["vec"], 0), asked["vec_id"].to_numpy()
        for i in range(0, len(wanted), 128):
            some = wanted[i:i + 128]
            far = norms - 2 * some @ matrix.T + (some**2).sum(1)[:, None]
            far[names[i:i + 128, None] == ids] = np.inf
            cut = np.partition(far, min(k, far.shape[1]) - 1, axis=1)[:, min(k, far.shape[1]) - 1]
            # What rounding may have put beyond the cut is measured exactly too.
            slack = 1e-9 * (norms.max() + (some**2).sum(1))
            for j, row in enumerate(far):
                near = np.flatnonzero((row <= cut[j] + slack[j]) & np.isfinite(row))
                exact = np.sqrt(((matrix[near] - some[j])**2).sum(1))
                first = np.lexsort((ids[near], exact))[:k]
                out.append((np.full(len(first), names[i + j]), ids[near][first], exact[first]))
    columns = [np.concatenate(c) for c in zip(*out, strict=True)] if out else [[], [], []]
    return pd.DataFrame({"query_id": columns[0], "vec_id": columns[1], "score": columns[2]})
