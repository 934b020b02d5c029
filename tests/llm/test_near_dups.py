import random
import re
from itertools import combinations

import numpy as np
from conftest import SMALL
from shapes import documents, folder, odd  # noqa: F401
from pyspark.sql import functions as F

from tallyfold.llm import near_dups as n
from tallyfold.llm import queries

LOWER = {c: c + 32 for c in range(65, 91)}


def shingles(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", (text or "").translate(LOWER))
    return {tuple(words[i:i + 2]) for i in range(max(len(words) - 1, 1))} if words else set()


def brute(docs):
    sets = {}
    for doc, text in docs:
        sets.setdefault(doc, []).append(shingles(text))
    root = {doc: doc for doc in sets}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a, b in combinations(sorted(sets), 2):
        if any(s and t and 100 * len(s & t) >= 80 * len(s | t) for s in sets[a] for t in sets[b]):
            x, y = sorted((find(a), find(b)))
            root[y] = x
    return {doc: find(doc) for doc in sets}


def near_copies(rng, base, count, share):
    for _ in range(count):
        words = base.split()
        for at in rng.sample(range(len(words)), int(share * len(words))):
            words[at] = f"n{rng.randint(0, 10**9)}"
        yield " ".join(words)


def test_query_against_brute_force(spark):
    docs = [(r["doc_id"], r["text"]) for r in spark.read.parquet(f"{SMALL}/documents.parquet").collect()]
    wanted = brute(docs)
    found = queries.op7(spark, SMALL).collect()
    assert {r["doc_id"]: r["component_id"] for r in found} == wanted
    sizes = {doc: len(shingles(text)) for doc, text in docs}
    assert all(r["n_shingles"] == sizes[r["doc_id"]] and r["kept"] == (wanted[r["doc_id"]] == r["doc_id"]) for r in found)
    assert len(set(wanted.values())) < len(wanted)


def test_hubs_chains_ties_and_copies(documents):
    rng = random.Random(3)
    text = [" ".join(f"h{k}w{i}" for i in range(120)) for k in range(3)]
    # A hub whose copies are too far from each other, with the hub's id in the middle.
    docs = [(50, text[0])] + [(i if i < 50 else i + 1, t) for i, t in enumerate(near_copies(rng, text[0], 99, 0.055))]
    # A chain: each a little further than the one before.
    step = text[1].split()
    for i in range(12):
        step = step.copy()
        step[i * 9] = f"c{i}"
        docs.append((200 + 37 * i % 12, " ".join(step)))
    docs += [(300 + i, text[2]) for i in range(60)]
    # Exactly at the bound (4 of 5 shingles) and below it.
    docs += [(400, "a b c d e f"), (401, "a b c d e"), (402, "p q r s t"), (403, "p q r s"), (404, "word"), (405, "WORD")]
    wanted = brute(docs)
    found = {r["doc_id"]: r["component_id"] for r in n.near_duplicate_classes(documents(*docs)).collect()}
    assert found == wanted
    assert wanted[401] == 400 and wanted[403] == 403 and wanted[405] == 404


def test_similar_sets_share_bands():
    rng = np.random.default_rng(5)
    for size in (1, 2, 5, 20, 300):
        missed = 0
        for _ in range(60):
            values = np.unique(rng.integers(0, 1 << 63, size * 5 // 4 + 1, dtype=np.uint64) * np.uint64(2))
            part = values[:max(1, int(np.ceil(len(values) * 0.8)))]
            one, other = n.densified(values), n.densified(part)
            missed += not (n.band_keys(one) == n.band_keys(other)).any()
            agree = (n.bin_bytes(one) == n.bin_bytes(other)).sum()
            assert agree >= n.least_agreement(np.array([len(part)]))[0]
        assert missed == 0


def test_bins_are_filled():
    for count in (1, 3, 24, 25, 200, 5000):
        values = np.unique(np.random.default_rng(count).integers(0, 1 << 63, count, dtype=np.uint64) * np.uint64(2))
        assert set(n.densified(values).tolist()) <= set(values.tolist())


def test_components_of_a_long_chain(rows):
    chain = [(i, i + 1) for i in range(200)] + [(500, 300), (300, 400)]
    random.Random(4).shuffle(chain)
    found = {r["node"]: r["component"] for r in n.components(rows("a long, b long", *chain)).collect()}
    assert found == {i: 0 for i in range(201)} | {300: 300, 400: 300, 500: 300}


def test_odd_rows(odd):
    found = n.near_duplicate_classes(odd).collect()
    assert len(found) == 12
    by = {}
    for r in found:
        by.setdefault(r["doc_id"], []).append((r["n_shingles"], r["component_id"], r["kept"]))
    assert by[1] == [(0, 1, True)] and by[2] == [(0, 2, True)] and by[3] == [(0, 3, True)]
    assert by[5] == [(1, 5, True)] and by[6] == [(1, 5, False)] * 2 and by[9] == [(5, 8, False)]
    assert sorted(by[None]) == [(0, None, True), (1, None, True)]
    assert n.near_duplicate_classes(odd.limit(0)).count() == 0


def test_rows_of_one_id_are_one_document(documents):
    docs = documents((1, "a b c d e"), (2, "p q r s t"), (2, "a b c d e"), (3, "p q r s t"), (4, "z z y"))
    found = n.near_duplicate_classes(docs).select("doc_id", "component_id").distinct()
    assert sorted(map(tuple, found.collect())) == [(1, 1), (2, 1), (3, 1), (4, 4)]


def test_no_pairs_within_groups(documents, monkeypatch):
    tried = []
    real = n.confirmed
    monkeypatch.setattr(n, "confirmed", lambda pairs, *a: tried.append(pairs.count()) or real(pairs, *a))
    base = " ".join(f"w{i}" for i in range(200))
    docs = documents(*enumerate(near_copies(random.Random(6), base, 150, 0.01)))
    found = n.near_duplicate_classes(docs)
    assert found.agg(F.max("component_id")).first()[0] == 0
    assert sum(tried) < 150 * 12


def test_texts_are_dealt_once(documents, monkeypatch):
    """Each round reads its texts where they were written; none moves the others again."""
    plans, real = [], n.materialize

    def seen(df, label):
        if label == "texts":
            plans.append(df._jdf.queryExecution().executedPlan().toString())
        return real(df, label)

    monkeypatch.setattr(n, "materialize", seen)
    spark = documents().sparkSession
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        base = " ".join(f"w{i}" for i in range(200))
        docs = documents(*enumerate(near_copies(random.Random(6), base, 60, 0.02)))
        assert n.near_duplicate_classes(docs).agg(F.max("component_id")).first()[0] == 0
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert plans
    for text in plans:
        lines = text.splitlines()
        scan = next(i for i, line in enumerate(lines) if "FileScan" in line and "text" in line and "Bucketed: true" in line)
        assert not [line for line in lines[:scan] if "Exchange" in line], text


def test_only_texts_that_share_a_bucket_are_written(documents, monkeypatch):
    """Texts without a neighbour are not stored; the last step writes a text once, not once for each bucket."""
    stored, written, real, create = [], [], n.materialize, n.stores.create

    def seen(df, label):
        out = real(df, label)
        if "text" in out.columns:
            written.append(out.count())
        return out

    def kept(df, *args, **kwargs):
        stored.append(df.count())
        return create(df, *args, **kwargs)

    monkeypatch.setattr(n, "materialize", seen)
    monkeypatch.setattr(n.stores, "create", kept)
    rng = random.Random(8)
    docs = []
    # Pairs just below the bound: they share buckets that no link settles.
    for k in range(20):
        base = " ".join(f"b{k}w{i}" for i in range(200))
        docs += [(2 * k, base), (2 * k + 1, next(near_copies(rng, base, 1, 0.06)))]
    docs += [(100 + k, " ".join(f"u{k}w{i}" for i in range(50))) for k in range(60)]
    wanted = brute(docs)
    assert {r["doc_id"]: r["component_id"] for r in n.near_duplicate_classes(documents(*docs)).collect()} == wanted
    assert len(set(wanted.values())) > 60 + 20
    assert stored == [40] and max(written) <= 40


def test_last_step_by_pairs_and_by_blocks(documents, monkeypatch):
    rng = random.Random(9)
    base = " ".join(f"w{i}" for i in range(150))
    docs = list(enumerate(near_copies(rng, base, 40, 0.05)))
    wanted = brute(docs)
    # No star meets anyone, so that all links are left to the last step.
    monkeypatch.setattr(n, "_least_centres", lambda members: members.select(
        "bucket", F.col("node").alias("centre"), F.col("n").alias("n_centre"), F.col("component").alias("component_centre")).limit(0))
    monkeypatch.setattr(n, "_centres", lambda open_, tried, turn: open_.select(
        "bucket", F.col("node").alias("centre"), F.col("n").alias("n_centre"), F.col("component").alias("component_centre")).limit(0))
    for few in (0, 1000):
        monkeypatch.setattr(n, "FEW_ASKED", few)
        found = n.near_duplicate_classes(documents(*docs))
        assert {r["doc_id"]: r["component_id"] for r in found.collect()} == wanted
