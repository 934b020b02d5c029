import hashlib
import random
import re

import numpy as np
import pyarrow as pa
from conftest import SMALL
from shapes import documents, folder, odd  # noqa: F401
from pyspark.sql import functions as F

from tallyfold.llm import decontaminate as d
from tallyfold.llm import queries
from tallyfold.llm.words import hashed_words, text_buffers

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
LOWER = {c: c + 32 for c in range(65, 91)}


def words(text):
    return WORD.findall((text or "").translate(LOWER))


def brute(text, items, window):
    ours, found = words(text), set()
    hit = [False] * len(ours)
    for item, theirs in items:
        theirs = words(theirs)
        for s in range(max(len(theirs) - window, 0) + 1 if theirs else 0):
            phrase = theirs[s:s + window]
            for k in range(len(ours) - len(phrase) + 1):
                if ours[k:k + len(phrase)] == phrase:
                    found.add(str(item))
                    hit[k:k + len(phrase)] = [True] * len(phrase)
    return len(ours), sum(hit), sorted(found)


def test_suffix_order():
    rng = random.Random(1)
    for _ in range(100):
        text = np.array([rng.randint(2, 4) for _ in range(rng.randint(0, 80))] + [d.END])
        order = d.suffix_order(text).tolist()
        assert order == sorted(range(len(text)), key=lambda i: text[i:].tolist())


def test_index_against_brute_force():
    rng = random.Random(2)
    for _ in range(60):
        letters = rng.sample(["a", "B", "c", "é", "d"], 3)
        docs = [" ".join(rng.choices(letters, k=rng.choice([0, 1, 4, 40, 90]))) for _ in range(6)] + [None, ""]
        items = [(i, " ".join(rng.choices(letters, k=rng.choice([0, 1, 3, 9])))) for i in range(5)]
        window, most = rng.choice([2, 3, 5]), rng.choice([12, 50, 1000])
        hashes, _, _, bounds = hashed_words(*text_buffers(pa.array(docs, pa.string())))
        theirs, _, _, edges = hashed_words(*text_buffers(pa.array([t for _, t in items], pa.string())))
        phrases = d.Phrases(np.arange(len(items)), theirs, edges, window)
        hit, found = np.zeros(len(hashes), bool), [set() for _ in docs]
        for phrase, at in d.occurrences(hashes, bounds, phrases, most):
            for p, x in zip(phrase.tolist(), at.tolist(), strict=True):
                hit[x:x + phrases.lengths[p]] = True
                owners = phrases.owners[phrases.owned[p]:phrases.owned[p + 1]]
                found[np.searchsorted(bounds, x, side="right") - 1].update(map(str, owners))
        for i, text in enumerate(docs):
            mine = (int(bounds[i + 1] - bounds[i]), int(hit[bounds[i]:bounds[i + 1]].sum()), sorted(found[i]))
            assert mine == brute(text, items, window)


def test_query_against_brute_force(spark):
    items = [(r["item_id"], r["text"]) for r in spark.read.parquet(f"{SMALL}/benchmark.parquet").collect()]
    windows = {}
    for item, text in items:
        ours = words(text)
        for s in range(max(len(ours) - 10, 0) + 1 if ours else 0):
            windows.setdefault(tuple(ours[s:s + 10]), set()).add(str(item))
    found = {r["doc_id"]: r for r in queries.op6(spark, SMALL).collect()}
    docs = spark.read.parquet(f"{SMALL}/documents.parquet").collect()
    assert len(found) == len(docs)
    for row in docs:
        ours, hit, names = words(row["text"]), set(), set()
        for size in {len(w) for w in windows}:
            for k in range(len(ours) - size + 1):
                if (owners := windows.get(tuple(ours[k:k + size]))) is not None:
                    names |= owners
                    hit.update(range(k, k + size))
        r = found[row["doc_id"]]
        assert (r["n_words"], r["n_hit"], r["n_items"]) == (len(ours), len(hit), len(names))
        assert r["items_sha256"] == hashlib.sha256(",".join(sorted(names)).encode()).hexdigest()
        assert r["contaminated"] == bool(hit)
    assert any(r["contaminated"] for r in found.values())


def test_blocks_of_the_benchmark_agree(spark, rows, monkeypatch):
    docs = rows("doc_id long, text string", (1, "x A b C d e f y"), (2, "b c d"), (3, "q"), (4, None))
    bench = rows("item_id long, text string", (1, "a b c"), (2, "c d e f"), (3, "q"), (4, ""), (None, "b"), (5, "f y"))
    whole = d.contaminated(docs, bench, 3).orderBy("doc_id").collect()
    monkeypatch.setattr(d.phrase_blocks, "__defaults__", ("item_id", "text", 3))
    parts = d.contaminated(docs, bench, 3).orderBy("doc_id").collect()
    assert whole == parts
    assert [(r["n_words"], [h["last"] - h["first"] for h in r["hits"]], r["items"]) for r in whole] == [
        (8, [7], ["1", "2", "5"]), (3, [], []), (1, [1], ["3"]), (0, [], [])]


def test_spans_are_cut_from_the_text(rows):
    docs = rows("doc_id long, text string", (1, "Ü: a b c, ü a B c!"), (2, None), (3, "none"))
    found = d.contaminated(docs, rows("item_id long, text string", (1, "a b c")), 3)
    left = found.select(d.without_hits("text", "hits"), d.hit_words("hits")).collect()
    assert [tuple(r) for r in left] == [("Ü: , ü !", 6), (None, 0), ("none", 0)]


def test_odd_rows(rows, odd):
    bench = rows("item_id long, text string", (1, "one"), (1, None), (2, ""))
    out = d.contaminated(odd, bench)
    assert out.count() == 12 and out.filter(F.size("hits") > 0).count() == 4
    assert d.contaminated(odd, bench.limit(0)).filter(F.size("hits") > 0).count() == 0
    assert d.contaminated(odd.limit(0), bench).count() == 0
