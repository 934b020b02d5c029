import re
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest
from conftest import values
from hypothesis import given, settings
from hypothesis import strategies as st
from shapes import LONG, documents, folder, odd  # noqa: F401

from tallyfold.llm import collocations, queries

ASCII = str.maketrans({chr(c): chr(c + 32) for c in range(65, 91)})


def brute(docs, least, longest, keep, share=50):
    """Collocations of (text, lang) by plain counting."""
    totals, counts = Counter(), defaultdict(Counter)
    for text, lang in docs:
        lang = "und" if lang is None else lang
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", (text or "").translate(ASCII)):
            words = re.findall(r"[^\x20\x09]+", piece)
            totals[lang] += len(words)
            for n in range(1, longest + 1):
                counts[lang].update(tuple(words[i:i + n]) for i in range(len(words) - n + 1))
    out = []
    for lang, found in counts.items():
        frequent = {p: a for p, a in found.items() if len(p) > 1 and a >= least}
        listed = []
        for p, a in frequent.items():
            if any(100 * b >= share * a and len(q) > len(p) and any(
                    q[i:i + len(p)] == p for i in range(len(q) - len(p) + 1)) for q, b in frequent.items()):
                continue
            score, _, left, right = min(
                (1_000_000 * a * a // (found[p[:k]] * found[p[k:]]), k, found[p[:k]], found[p[k:]])
                for k in range(1, len(p)))
            listed.append((-score, -a, " ".join(p).encode(), left, right))
        for rank, (score, a, p, left, right) in enumerate(sorted(listed)[:keep], 1):
            out.append((lang, rank, p.decode(), -a, left, right, totals[lang], -score))
    return sorted(out, key=repr)


def found(df):
    return values(df, "lang", "rank", "phrase", "a", "l", "r", "n", "score")


TEXTS = [
    "New York is big. New York, new york! The New York Times\tis in New  York City",
    "a b c a b c; a b c: a b\nc a b c d", "É é É É é", None, "", " . ,; ", "x\x0by\rz x y z", "to be or not to be " * 9]
DOCS = [(t, lang) for t in TEXTS for lang in ("en", None, "und", "fr", "en")]


@pytest.mark.parametrize("least, longest, keep, shards", [(10, 3, 2000, 4), (2, 3, 5, 1), (3, 5, 50, 2), (1, 2, 9, 3)])
def test_against_brute_force(rows, least, longest, keep, shards):
    docs = rows("text string, lang string", *DOCS).repartition(3)
    got = collocations.collocations(docs, least, longest, keep, shards)
    assert found(got) == brute(DOCS, least, longest, keep)


def test_a_phrase_in_one_shard_or_spread_over_all(rows):
    """Whatever the texts, nothing found often enough is lost by the lowered support."""
    docs = [(f"rare pair number{i} here", "en") for i in range(10)] + [("one place only. " * 10, "en")]
    docs += [(f"nine times {i} said", "de") for i in range(9)]
    got = found(collocations.collocations(rows("text string, lang string", *docs)))
    assert got == brute(docs, 10, 3, 2000) and {r[2] for r in got} == {"rare pair", "one place only"}


def test_a_full_filter_changes_nothing(rows, monkeypatch):
    docs = rows("text string, lang string", *DOCS)
    monkeypatch.setattr(collocations, "MOST_BITS", 64)
    assert found(collocations.collocations(docs, 3, 4, 50, 2)) == brute(DOCS, 3, 4, 50)


def test_runs_of_any_size(rows, monkeypatch):
    docs = rows("text string, lang string", *DOCS)
    monkeypatch.setattr(collocations, "AT_ONCE", 1)
    assert found(collocations.collocations(docs, 3, 3, 50, 2)) == brute(DOCS, 3, 3, 50)


def test_filter_holds_its_keys(spark):
    keys = np.random.default_rng(1).integers(-(1 << 63), 1 << 63, 5_000)
    made = collocations._Filter(spark.createDataFrame([(int(k),) for k in keys], "key long"))
    assert made.passes(keys.view(np.uint64)).all()
    others = np.random.default_rng(2).integers(0, 1 << 63, 5_000).view(np.uint64)
    assert made.passes(others).mean() < 0.05


@settings(max_examples=40, deadline=None)
@given(st.lists(st.text(st.sampled_from("aAbé .,\n\t"), max_size=30), max_size=5))
def test_places_of_phrases(texts):
    words = collocations._Run(pa.array(texts, pa.string()), pa.array([None] * len(texts), pa.string()))
    for n in (1, 2, 3):
        wanted = sum(
            max(len(re.findall(r"[^ \t]+", piece)) - n + 1, 0)
            for t in texts for piece in re.split(r"[.,;:!?\x0A-\x0D]", t))
        assert len(words.at(n)) == wanted


def test_scores_are_exact(rows):
    a, left, right = 9_007_199_254_740_993, 9_007_199_254_740_995, 9_999_999_999_999_999
    got = rows("a long, l long, r long", (a, left, right), (10, 10, 10), (10, 11, 13)).select(
        collocations._score("a", "l", "r"))
    assert [r[0] for r in got.collect()] == [1_000_000 * a * a // (left * right), 1_000_000, 100_000_000 // 143]


def test_odd_rows(odd):
    some = [(r["text"], r["lang"]) for r in odd.collect()]
    assert found(collocations.collocations(odd, 2, 3, 100, 1)) == brute(some, 2, 3, 100)
    assert collocations.collocations(odd.limit(0)).count() == 0


def test_query_keeps_2000(spark, rows, folder, documents):
    path = folder(documents=documents(*[(i, f"w{i // 10} v{i // 10}") for i in range(21_000)]))
    got = queries.op13(spark, path)
    assert got.count() == 2000 and got.filter("score = 1000000 and a = 10 and n = 42000").count() == 2000
