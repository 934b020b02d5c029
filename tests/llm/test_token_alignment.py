import hashlib
from collections import Counter

import pyarrow as pa
import public_tokenizers
import pytest
import sentencepiece
from conftest import SMALL
from shapes import LONG, documents, folder, odd  # noqa: F401
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from tallyfold.llm import queries, token_alignment

A, B = (str(public_tokenizers.path(n)) for n in ("byte_bpe_50k.json", "piece_bpe_32k.model"))
TEXT = st.text(st.sampled_from("aabbcdeé ' \n\t1<|endoftext|>日ß▁ﬁ½!\x01"), max_size=60)
FIELDS = ("doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups")


@pytest.fixture(scope="module")
def spell():
    """Both tokenizers: lists of (id, bytes) of a text."""
    a, b = Tokenizer.from_file(A), sentencepiece.SentencePieceProcessor(model_file=B)
    a.encode_special_tokens = True
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    others = [x for x in range(256) if x not in plain]
    byte_of = {chr(x): x for x in plain} | {chr(256 + i): x for i, x in enumerate(others)}

    def run(text):
        ids_a = a.encode(" " + text, add_special_tokens=False).ids
        ids_b = b.encode(text)
        said_b = [b.id_to_piece(i) for i in ids_b]
        return (
            [(i, bytes(byte_of[c] for c in a.id_to_token(i))) for i in ids_a],
            [(i, bytes([int(p[3:5], 16)]) if b.is_byte(i) else p.replace("▁", " ").encode())
             for i, p in zip(ids_b, said_b, strict=True)])

    return run


def brute(texts, spell):
    """Every pair of tokens compared by its byte ranges."""
    links, shown, counts = [], [], Counter()
    for text in texts:
        mine, groups = [], ""
        if text:
            ranges = []
            for tokens in spell(text):
                at, out = 0, []
                for i, raw in tokens:
                    out.append((i, at, at + len(raw)))
                    at += len(raw)
                ranges.append((out, b"".join(raw for _, raw in tokens)))
            (a, raw_a), (b, raw_b) = ranges
            if raw_a == raw_b == f" {text}".encode():
                mine = [(x, y) for x, s, e in a for y, t, f in b if s < f and t < e]
                cuts = sorted({e for *_, e in a} & {f for *_, f in b})
                parts = []
                for low, high in zip([0, *cuts], cuts, strict=False):
                    parts.append("|".join(
                        ",".join(str(i) for i, s, e in tokens if low <= s and e <= high) for tokens in (a, b)))
                groups = ";".join(parts)
                shown.append((len(a), len(b), len(parts), groups))
        if not groups:
            shown.append((0, 0, 0, ""))
        links.append(mine)
        counts.update(mine)
    top = {}
    for (_, y), n in counts.items():
        top[y] = max(top.get(y, 0), n)
    return [
        (*numbers, len(mine), sum(counts[p] == top[p[1]] for p in mine), sum(counts[p] for p in mine), groups)
        for mine, (*numbers, groups) in zip(links, shown, strict=True)]


def flat(rows):
    return [tuple(r[c] for c in FIELDS[1:]) for r in rows]


def test_runs_against_brute_force(spell):
    pair = token_alignment.Pair(A, B)

    @settings(max_examples=200, deadline=None)
    @given(st.lists(st.none() | TEXT, min_size=1, max_size=4))
    def check(texts):
        numbers, groups, counted = token_alignment.aligned_run(pair, texts)
        wanted = brute(texts, spell)
        found = list(zip(*(numbers[c].to_pylist() for c in token_alignment.NUMBERS), groups.to_pylist(), strict=True))
        assert found == [(*w[:4], w[-1]) for w in wanted]
        total = Counter()
        for pair_, n in zip(counted["pair"].to_pylist(), counted["n"].to_pylist(), strict=True):
            total[pair_] += n
        assert sum(total.values()) == sum(w[3] for w in wanted)

    check()


def test_counts_over_all_blocks(spark, documents, spell):
    texts = ["the cat sat", "the cat sat", "a cat's hat, the end", "naïve café ½ ﬁt", "", None, "  two  spaces ",
             "<|endoftext|> <s> </s>", "日本語 text", "x" * 70, "the " * 40]
    docs = documents(*enumerate(texts))
    wanted = {i: w for i, w in enumerate(brute(texts, spell))}
    for bytes_ in (1, 60, 1 << 20):
        rows = token_alignment.aligned(docs.repartition(3), A, B, block_bytes=bytes_).collect()
        assert {r["doc_id"]: flat([r])[0] for r in rows} == wanted
        assert tuple(rows[0].asDict()) == FIELDS


def test_query_against_brute_force(spark, spell):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet").select("doc_id", "text").filter("length(text) < 1500")
    rows = docs.collect()
    wanted = brute([r["text"] for r in rows], spell)
    found = token_alignment.aligned(docs, A, B).collect()
    assert sorted(flat(found)) == sorted(wanted)
    whole = {r["doc_id"]: r for r in queries.op11(spark, SMALL).collect()}
    assert len(whole) == spark.read.parquet(f"{SMALL}/documents.parquet").count()
    for row, w in zip(rows, wanted, strict=True):
        r = whole[row["doc_id"]]
        assert (r["n_a"], r["n_b"], r["n_groups"], r["n_links"]) == w[:4]
        assert r["groups_sha256"] == (hashlib.sha256(w[-1].encode()).hexdigest() if w[-1] else "")


def test_odd_rows(odd):
    rows = token_alignment.aligned(odd, A, B).collect()
    assert len(rows) == 12
    assert [r["n_links"] for r in rows if r["doc_id"] in (1, 2) or r["groups"] == ""] == [0] * sum(
        r["groups"] == "" for r in rows)
    one = [r for r in rows if r["doc_id"] in (5, 6)]
    assert len(one) == 3 and len({r["groups"] for r in one}) == 1 and all(r["n_best"] == r["n_links"] > 0 for r in one)
    long = next(r for r in rows if r["doc_id"] == 4)
    assert long["n_a"] > 30_000 and long["n_links"] == long["n_a"] + long["n_b"] - long["n_groups"]
    assert token_alignment.aligned(odd.limit(0), A, B).count() == 0


def test_packing():
    import numpy as np

    places, n = np.array([3, 9, 1, 1 << 20, 0]), np.array([1, 70_000, 2, 1, 5])
    back = token_alignment._unpacked(token_alignment._packed(places, n))
    assert back[0].tolist() == places.tolist() and back[1].tolist() == n.tolist()
    none = np.empty(0, np.int64)
    assert len(token_alignment._unpacked(token_alignment._packed(none, none))[0]) == 0
    assert token_alignment._digests(pa.array(["", "a"]))[0].as_py() == ""
