"""Near-duplicate documents by one-permutation MinHash and star-shaped candidates.

A document's set is its distinct shingles of words, hashed to 64 bits. One hash deals the shingles into bins,
the least of each bin is its value, and an empty bin takes the value of a filled one, drawn for
that bin alone (optimal densification). Bands of several bins are the buckets.

1. Documents with equal sets become one node, the smallest id, so groups of copies are one row.
2. In each bucket one node is the centre; it is paired with every other, a star, so a bucket gives
   fewer pairs than it has members.
3. A pair is confirmed on the full sets of both texts.
4. Confirmed links are joined to components. The bands are worked on in two groups: a bucket whose members the
   first has joined makes no pairs in the second. Buckets whose members are then not yet in one component go
   through two more rounds of stars: with a centre at random, another in each bucket, and with the
   node of most links, so that a text near to many finds them.
5. In buckets that are then still apart, the members outside of the largest component meet all
   others. Where they are few, each pair not yet tried is confirmed, once for all buckets that
   both are in. Where they are many, they are compared by a byte of each bin, in blocks of bounded
   size; pairs that agree in about as many bins as similar texts must are confirmed, until their
   components are linked. So no bucket is cut short.

Buckets are never collected; all steps but the blocks are joins and combining aggregates. Buckets of one
node are dropped at the start, and only texts of nodes that share a bucket are written. Two documents
of similarity 0.8 miss each other in every bucket with a probability of (1 - 0.8**6)**40 = 5e-6, and
more similar ones less. The blocks of step 5 pass over a pair of similarity 0.8 with a probability of about
the same (4.5 standard deviations), if no star has tried it and nothing else joins its components.

Defined cases: null and empty texts, and texts without words, have an empty set, are linked with
nothing and are kept. A row with a null id is returned unlinked, with no component. Rows that share an
id are one document with several sets: a link of any of them counts for the id.
"""

from __future__ import annotations

import hashlib
import itertools
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyfold.llm.words import SPACED_BYTES, hashed_words, mixed, slices, text_buffers
from tallyfold.operators import stores
from tallyfold.operators.stores import Store
from tallyfold.session import materialize

SHINGLE = 2
#: Least similarity of a link, as a fraction of whole numbers so that ties are exact.
SIMILAR = (80, 100)
BANDS, ROWS = 40, 6
BINS = BANDS * ROWS
#: The bands are worked on in these groups (first of each, and their number).
BAND_GROUPS = (0, 8, BANDS)
#: Members of a bucket, and members outside of its main component, that are compared in one block.
ROW_BLOCK, ASKED_BLOCK = 4096, 256
#: With so few members outside of its main component a bucket of one block makes pairs of them and all its members.
FEW_ASKED = 8
#: Standard deviations below the least similarity at which the bins of a pair may agree.
SIGMAS = 4.5
#: Hashes of sets that a task keeps while it confirms pairs.
KEPT_HASHES = 1 << 20
#: Bytes of text whose words are hashed at once.
AT_ONCE = 1 << 20
#: Pairs whose texts are unpacked at once.
PAIRS = 256
#: Documents of a bucket of the written texts, about.
TEXT_ROWS = 16_384
#: With so few filled bins each empty one looks at all of them, else it draws until it finds one.
SPARSE = 24

_DRAW = np.random.default_rng(20240601)
#: For each bin an order of all bins: a filled bin is taken in this order, and its place in it.
_ORDER = np.argsort(_DRAW.random((BINS, BINS)), axis=1).astype(np.int16)
_PLACE = np.argsort(_ORDER, axis=1).astype(np.int16)
_WEIGHTS = _DRAW.integers(1, 1 << 63, (BANDS, ROWS), dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_BAND = _DRAW.integers(1, 1 << 63, BANDS, dtype=np.uint64)


def shingle_hashes(words: np.ndarray, size: int = SHINGLE) -> np.ndarray:
    """Hashes of all runs of ``size`` words; of the whole sequence if it is shorter."""
    if not len(words):
        return words
    size = min(size, len(words))
    count = len(words) - size + 1
    out = np.full(count, size, np.uint64)
    for i in range(size):
        out = mixed(out * np.uint64(0x9E3779B97F4A7C15) + words[i:i + count])
    return out


def densified(distinct: np.ndarray) -> np.ndarray:
    """The value of each bin for sorted distinct hashes (at least one)."""
    bins = ((distinct >> np.uint64(32)) * np.uint64(BINS) >> np.uint64(32)).astype(np.int64)
    first = np.flatnonzero(np.append(True, bins[1:] != bins[:-1]))
    filled, least = bins[first], distinct[first]
    values = np.zeros(BINS, np.uint64)
    values[filled] = least
    if len(filled) == BINS:
        return values
    has = np.zeros(BINS, bool)
    has[filled] = True
    empty = np.flatnonzero(~has)
    if len(filled) <= SPARSE:
        values[empty] = least[np.argmin(_PLACE[empty][:, filled], axis=1)]
        return values
    draw = 0
    while len(empty):
        taken = _ORDER[empty, draw]
        found = has[taken]
        values[empty[found]] = values[taken[found]]
        empty = empty[~found]
        draw += 1
    return values


def band_keys(bins: np.ndarray) -> np.ndarray:
    """One 64-bit bucket for each band of ``densified`` bins."""
    rows = bins.reshape(BANDS, ROWS)
    return mixed((mixed(rows * _WEIGHTS) * _WEIGHTS).sum(axis=1, dtype=np.uint64) + _BAND)


def bin_bytes(bins: np.ndarray) -> np.ndarray:
    """A byte of each bin; other bins share it once in 256 times."""
    return mixed(bins).astype(np.uint8)


def least_agreement(sizes: np.ndarray, similar=SIMILAR) -> np.ndarray:
    """Bins that a similar pair agrees in, but for a chance of SIGMAS; by the size of the smaller set.

    The bins of a small set hang together: there are only as many draws as it fills.
    """
    share = similar[0] / similar[1]
    filled = BINS * (1 - (1 - 1 / BINS) ** sizes)
    return BINS * (share - SIGMAS * np.sqrt(share * (1 - share) / filled))


def distinct_shingles(column: pa.Array, size: int = SHINGLE) -> Iterator[np.ndarray]:
    """The sorted set of each text."""
    for part in slices(column, AT_ONCE):
        data, offsets = text_buffers(column[part])
        words, _, _, bounds = hashed_words(data, offsets, SPACED_BYTES)
        for i, j in zip(bounds[:-1].tolist(), bounds[1:].tolist(), strict=True):
            all_ = np.sort(shingle_hashes(words[i:j], size))
            yield all_[np.append(True, all_[1:] != all_[:-1])] if len(all_) else all_


def signatures(docs: DataFrame, size: int = SHINGLE) -> DataFrame:
    """doc_id, n_shingles, set_key (128-bit digest of the set), bands and a byte for each bin.

    The last three are null for an empty set.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            counts, keys, bands, marks = [], [], [], []
            for one in distinct_shingles(batch.column(1), size):
                counts.append(len(one))
                bins = densified(one) if len(one) else None
                keys.append(hashlib.blake2b(one.tobytes(), digest_size=16).digest() if len(one) else None)
                bands.append(band_keys(bins).view(np.int64) if len(one) else None)
                marks.append(bin_bytes(bins).tobytes() if len(one) else None)
            yield pa.RecordBatch.from_arrays([
                batch.column(0), pa.array(counts, pa.int64()), pa.array(keys, pa.binary()),
                pa.array(bands, pa.list_(pa.int64())), pa.array(marks, pa.binary()),
            ], names=["doc_id", "n_shingles", "set_key", "bands", "marks"])

    return docs.select("doc_id", "text").mapInArrow(
        run, "doc_id bigint, n_shingles bigint, set_key binary, bands array<bigint>, marks binary")


def _short(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
    """Runs of PAIRS rows of a batch."""
    return (batch.slice(at, PAIRS) for at in range(0, len(batch), PAIRS))


def confirmed(pairs: DataFrame, texts: DataFrame, size: int = SHINGLE, similar=SIMILAR) -> DataFrame:
    """The pairs a, b and whether their full sets are similar enough. ``texts``: node, text."""
    at_least, of = similar
    both = (
        pairs.join(texts.withColumnsRenamed({"node": "a", "text": "text_a"}), "a")
        .join(texts.withColumnsRenamed({"node": "b", "text": "text_b"}), "b")
        .select("a", "b", "text_a", "text_b")
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kept: dict[str, np.ndarray] = {}
        held = 0
        for batch in itertools.chain.from_iterable(map(_short, batches)):
            linked = []
            if held > KEPT_HASHES:
                kept, held = {}, 0
            # A centre's text comes with each of its pairs: its set is made once.
            texts = batch.column(2).to_pylist(), batch.column(3).to_pylist()
            new = [t for t in dict.fromkeys(itertools.chain(*texts)) if t not in kept]
            for text, one in zip(new, distinct_shingles(pa.array(new, pa.string()), size), strict=True):
                kept[text] = one
                held += len(one)
            for one, other in zip(map(kept.get, texts[0]), map(kept.get, texts[1]), strict=True):
                common = len(np.intersect1d(one, other, assume_unique=True))
                linked.append(of * common >= at_least * (len(one) + len(other) - common))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(linked, pa.bool_())], names=["a", "b", "linked"])

    return both.mapInArrow(run, "a bigint, b bigint, linked boolean")


def components(links: DataFrame) -> DataFrame:
    """node, component (its smallest node) for every node of the links a, b.

    Large-star and small-star steps in turn: each node's neighbours are hung on the least of them,
    first those above the node, then those below. The number of rounds grows with the logarithm of a
    chain's length. A node of very many links is a combining minimum and a join that adaptive
    execution can split.
    """
    edges, before = links.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")), None
    while True:
        ways = edges.union(edges.select("v", "u"))
        least = ways.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("least"))
        large = ways.filter("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("least").alias("v"))
        large = large.distinct()
        least = large.groupBy("u").agg(F.min("v").alias("least"))
        small = large.join(least, "u").select(F.col("v").alias("u"), F.col("least").alias("v"))
        edges = materialize(
            least.select("u", F.col("least").alias("v")).union(small.filter("u != v")).distinct(), "stars")
        now = edges.agg(
            F.count("*").alias("n"), F.bit_xor(F.xxhash64("u", "v")).alias("x"),
            F.sum(F.col("v").cast("decimal(38,0)")).alias("s")).first()
        if now == before:
            break
        before = now
    stars = edges.withColumnsRenamed({"u": "node", "v": "component"})
    return stars.union(edges.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct())


def near_duplicate_classes(docs: DataFrame, size: int = SHINGLE) -> DataFrame:
    """doc_id, n_shingles, component_id, kept: one row for each row of ``docs``."""
    signed = materialize(signatures(docs, size), "signatures")
    shingled = signed.filter("set_key is not null and doc_id is not null")
    # Equal sets have equal bands: the least row of each, combined where the rows lie.
    least = F.min(F.struct("doc_id", "n_shingles", "bands")).alias("least")
    nodes = materialize(shingled.groupBy("set_key").agg(least).select(
        "set_key", F.col("least.doc_id").alias("node"), F.col("least.n_shingles").alias("n"), "least.bands"), "nodes")
    found = _linked(docs, signed, nodes, _of_one_id(shingled, nodes), size)
    classed = signed.select("doc_id", "n_shingles", "set_key").join(nodes.select("set_key", "node"), "set_key", "left")
    classed = classed.join(found, "node", "left")
    component = F.when(F.col("doc_id").isNotNull(), F.coalesce("component", "node", "doc_id"))
    return classed.select(
        "doc_id", "n_shingles", component.alias("component_id"),
        F.coalesce(F.col("doc_id") == component, F.lit(True)).alias("kept"),
    )


def _of_one_id(shingled: DataFrame, nodes: DataFrame) -> DataFrame | None:
    """Links between the nodes of ids that have several sets; None where each id has one."""
    several = shingled.groupBy("doc_id").agg(
        F.min("set_key").alias("low"), F.max("set_key").alias("high")).filter("low < high")
    several = materialize(several.select("doc_id"), "repeated-ids")
    if several.isEmpty():
        return None
    own = materialize(
        shingled.join(several, "doc_id").join(nodes, "set_key").select("doc_id", "node").distinct(), "own-nodes")
    least = own.groupBy("doc_id").agg(F.min("node").alias("a"))
    return own.join(least, "doc_id").select("a", F.col("node").alias("b")).filter("a != b")


def _linked(docs, signed, nodes, links, size):
    """node, component of every node."""
    # A node has several rows only where an id has several sets.
    once = nodes.select("node", "n", "bands") if links is None else materialize(
        nodes.select("node", "n", "bands").dropDuplicates(["node"]), "signed")
    found = once.select("node", F.col("node").alias("component"))
    if links is not None:
        found = materialize(_relabelled(found, links), "components")
    shared = _shared(once)
    if shared.isEmpty():
        return found
    docs = _stored(docs, shared.select("node"), signed.count())
    tried = None
    # A group of bands at a time: buckets that the groups before have settled make no pairs.
    for first, last in itertools.pairwise(BAND_GROUPS):
        members = shared.filter(F.col("band").between(first, last - 1)).drop("band").join(found, "node")
        found, tried = _starred(members, _least_centres(members), found, tried, docs, size)
    members = shared.drop("band")
    for turn in (1, 2):
        open_ = _unsettled(members, found)
        if open_.isEmpty():
            return found
        members = open_.drop("component")
        found, tried = _starred(open_, _centres(open_, tried, turn), found, tried, docs, size)
    open_ = _unsettled(members, found)
    if open_.isEmpty():
        return found
    sizes = found.groupBy("component").agg(F.count("*").alias("size"))
    mains = open_.join(sizes, "component").groupBy("bucket").agg(
        F.count("*").alias("rows"), F.max(F.struct("size", "component"))["component"].alias("main"))
    open_ = open_.join(materialize(mains, "mains"), "bucket")
    asked = open_.filter("component != main").groupBy("bucket").agg(F.count("*").alias("n_asked"))
    open_ = materialize(open_.join(materialize(asked, "asked"), "bucket"), "last")
    few = (F.col("n_asked") <= FEW_ASKED) & (F.col("rows") <= ROW_BLOCK)
    new = _pair_links(open_.filter(few), tried, docs, size)
    many = open_.filter(~few)
    if not many.isEmpty():
        wanted = many.select("node").distinct()
        own = nodes.join(wanted, "node", "left_semi").select("set_key", "node")
        facts = signed.join(own, "set_key").filter("doc_id = node").select("node", "bands", "marks")
        blocks = _block_links(many, facts.dropDuplicates(["node"]), _texts(docs, wanted), size)
        new = new.union(materialize(blocks, "last-links"))
    return found if new.isEmpty() else materialize(_relabelled(found, new), "components")


def _shared(nodes: DataFrame) -> DataFrame:
    """node, n, band, bucket: the members of buckets of several nodes. Most buckets have one, and go here."""
    members = nodes.select("node", "n", F.posexplode("bands").alias("band", "bucket"))
    several = members.groupBy("bucket").agg(F.count("*").alias("rows")).filter("rows > 1").select("bucket")
    return materialize(members.join(materialize(several, "buckets"), "bucket", "left_semi"), "shared")


def _stored(docs: DataFrame, nodes: DataFrame, rows: int) -> Store:
    """node, text of the documents that are nodes, dealt by node once: each round picks its texts from them without moving the others."""
    buckets = max(docs.sparkSession.sparkContext.defaultParallelism, -(-rows // TEXT_ROWS))
    # Both sides are dealt as the store is, so that it is written without a further shuffle.
    texts = docs.filter("doc_id is not null").select(F.col("doc_id").alias("node"), "text").repartition(buckets, "node")
    wanted = nodes.distinct().repartition(buckets, "node")
    return stores.create(texts.join(wanted.hint("shuffle_hash"), "node", "left_semi"), ["node"], buckets)


def _texts(docs: Store, wanted: DataFrame) -> DataFrame:
    """node, text of the nodes wanted."""
    return materialize(docs.known(wanted), "texts")


def _unsettled(members: DataFrame, found: DataFrame) -> DataFrame:
    """bucket, node, n, component: the members of buckets whose members are not yet one component."""
    placed = members.join(found, "node")
    apart = placed.groupBy("bucket").agg(
        F.min("component").alias("low"), F.max("component").alias("high")).filter("low < high")
    # Written, so that the join with it is of plain shuffles, whose skewed parts can be split.
    apart = materialize(apart.select("bucket"), "apart")
    return materialize(placed.join(apart, "bucket").select("bucket", "node", "n", "component"), "open")


def _least_centres(members: DataFrame) -> DataFrame:
    """bucket, centre (its least node), n_centre, component_centre of each bucket of several components."""
    top = F.min(F.struct("node", "n", "component")).alias("top")
    ends = F.min("component").alias("low"), F.max("component").alias("high")
    return members.groupBy("bucket").agg(top, *ends).filter("low < high").select(
        "bucket", F.col("top.node").alias("centre"), F.col("top.n").alias("n_centre"),
        F.col("top.component").alias("component_centre"))


def _starred(members, centres, found, tried, docs, size):
    """Components and pairs tried, after each centre has met the members of its bucket that are not in its component."""
    seen = _met(members, materialize(centres, "centres"), tried, docs, size)
    tried = seen if tried is None else tried.union(seen)
    new = seen.filter("linked")
    return (found if new.isEmpty() else materialize(_relabelled(found, new), "components")), tried


def _met(members, centres, tried, docs, size):
    """a, b, linked: the members of each bucket with its centres of other components, but for pairs tried before."""
    at_least, of = SIMILAR
    centres = centres.withColumnRenamed("bucket", "at")
    # A set of less than 4/5 of another's size cannot reach the similarity.
    rays = members.join(centres, (F.col("bucket") == F.col("at")) & (F.col("component") != F.col("component_centre")) & (
        of * F.least("n", "n_centre") >= at_least * F.greatest("n", "n_centre")))
    pairs = rays.select(
        F.least("node", "centre").alias("a"), F.greatest("node", "centre").alias("b")).distinct()
    if tried is not None:
        pairs = pairs.join(tried.select("a", "b"), ["a", "b"], "left_anti")
    pairs = materialize(pairs, "pairs")
    if pairs.isEmpty():
        return pairs.withColumn("linked", F.lit(False))
    texts = _texts(docs, pairs.select("a").union(pairs.select("b")).toDF("node"))
    return materialize(confirmed(pairs, texts, size), "tried")


def _pair_links(open_: DataFrame, tried: DataFrame, docs: Store, size: int) -> DataFrame:
    """Links a, b between members of one bucket, for buckets of few members outside of the main component.

    A pair comes once, whatever the number of buckets that both are in.
    """
    asked = open_.filter("component != main").select(
        "bucket", F.col("node").alias("centre"), F.col("n").alias("n_centre"), F.col("component").alias("component_centre"))
    return _met(open_, asked, tried, docs, size).filter("linked").select("a", "b")


def _centres(open_: DataFrame, tried: DataFrame, turn: int) -> DataFrame:
    """The next centre of each bucket: bucket, centre, n_centre, component_centre.

    First one at random, another in each bucket, so that a text near to many is found out by its links;
    then the one of most links.
    """
    random = F.xxhash64("node", "bucket")
    if turn == 1:
        chosen, rank = open_, F.struct(random)
    else:
        chosen = open_.join(_degrees(tried), "node", "left")
        rank = F.struct(F.coalesce("degree", F.lit(0)), random)
    top = F.max(F.struct(rank.alias("rank"), "node", "n", "component")).alias("top")
    return chosen.groupBy("bucket").agg(top).select(
        "bucket", F.col("top.node").alias("centre"), F.col("top.n").alias("n_centre"),
        F.col("top.component").alias("component_centre"))


def _block_links(open_: DataFrame, facts: DataFrame, texts: DataFrame, size: int) -> DataFrame:
    """Links a, b between members of one bucket that are in different components.

    Members outside of a bucket's main component (asked) meet all its members, block by block; the
    main component's own members are not compared with each other.
    """
    known = materialize(open_.join(facts, "node").join(texts, "node"), "marked")
    asked = known.filter("component != main")
    row_blocks = F.ceil(F.col("rows") / F.lit(ROW_BLOCK)).cast("int")
    asked_blocks = F.ceil(F.col("n_asked") / F.lit(ASKED_BLOCK)).cast("int")

    def dealt(rows: DataFrame, own: str, blocks: Column, other: str, others: Column) -> DataFrame:
        placed = rows.withColumn(own, F.pmod(F.xxhash64("node"), blocks).cast("int"))
        copies = placed.withColumn(other, F.explode(F.sequence(F.lit(0), others - 1)))
        # New names of the same columns: both sides come from one table.
        return copies.select(*[F.col(c).alias(c) for c in (
            "bucket", "row_block", "asked_block", "node", "n", "component", "bands", "marks", "text")])

    def linked(rows: pd.DataFrame, some: pd.DataFrame) -> pd.DataFrame:
        return block_links(rows, some, size)

    keys = ["bucket", "row_block", "asked_block"]
    left = dealt(known, "row_block", row_blocks, "asked_block", asked_blocks).groupBy(*keys)
    right = dealt(asked, "asked_block", asked_blocks, "row_block", row_blocks).groupBy(*keys)
    return left.cogroup(right).applyInPandas(linked, "a bigint, b bigint").distinct()


def block_links(rows: pd.DataFrame, asked: pd.DataFrame, size: int) -> pd.DataFrame:
    """For each asked member a confirmed link to each other component in the block that has one.

    Candidates agree in enough bins; they are confirmed on the full sets, those that agree most
    first, until their component is linked. A pair is looked at only in the first of the buckets that both
    are in.
    """
    at_least, of = SIMILAR
    out: list[tuple[int, int]] = []
    if len(rows) and len(asked):
        matrix = np.frombuffer(b"".join(rows["marks"]), np.uint8).reshape(len(rows), BINS)
        bands = np.stack(rows["bands"].to_list())
        ids, sizes, parts = (rows[c].to_numpy() for c in ("node", "n", "component"))
        sets = list(distinct_shingles(pa.array(rows["text"], pa.string()), size))
        theirs = distinct_shingles(pa.array(asked["text"], pa.string()), size)
        bucket = rows["bucket"].iloc[0]
        columns = (asked["node"], asked["n"], asked["component"], asked["bands"], asked["marks"], theirs)
        for node, n, part, keys, raw, one in zip(*columns, strict=True):
            low, high = np.minimum(sizes, n), np.maximum(sizes, n)
            same = bands == keys
            agree = (matrix == np.frombuffer(raw, np.uint8)).sum(axis=1)
            near = np.flatnonzero(
                (parts != part) & (of * low >= at_least * high) & (agree >= least_agreement(low))
                & (np.asarray(keys)[same.argmax(axis=1)] == bucket))
            reached: set[int] = set()
            for at in near[np.argsort(-agree[near], kind="stable")].tolist():
                if parts[at] not in reached:
                    common = len(np.intersect1d(one, sets[at], assume_unique=True))
                    if of * common >= at_least * (len(one) + len(sets[at]) - common):
                        reached.add(parts[at])
                        out.append((min(node, ids[at]), max(node, ids[at])))
    pairs = np.array(out, np.int64).reshape(-1, 2)
    return pd.DataFrame({"a": pairs[:, 0], "b": pairs[:, 1]})


def _degrees(tried: DataFrame) -> DataFrame:
    links = tried.filter("linked")
    ends = links.select("a").union(links.select("b")).toDF("node")
    return ends.groupBy("node").agg(F.count("*").alias("degree"))


def _relabelled(found: DataFrame, links: DataFrame) -> DataFrame:
    """node, component after new links: only the components that they touch are joined anew."""
    left = found.select(F.col("node").alias("a"), F.col("component").alias("u"))
    right = found.select(F.col("node").alias("b"), F.col("component").alias("v"))
    merged = links.select("a", "b").join(left, "a").join(right, "b").select(
        F.col("u").alias("a"), F.col("v").alias("b")).filter("a != b").distinct()
    merged = materialize(merged, "merges")
    if merged.isEmpty():
        return found
    moved = components(merged).select(F.col("node").alias("component"), F.col("component").alias("into"))
    return found.join(moved, "component", "left").select(
        "node", F.coalesce("into", "component").alias("component"))
