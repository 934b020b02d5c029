import hashlib

import public_tokenizers
import pytest
from conftest import SMALL
from shapes import documents, folder, odd  # noqa: F401
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from tallyfold.llm import bpe, queries

PATH = str(public_tokenizers.path("byte_bpe_50k.json"))
TEXT = st.text(st.sampled_from("aabbcdeé ' \n\t\r1<|endoftext|>日ß  \x1ć½!"), max_size=60)


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(PATH)


@pytest.fixture(scope="module")
def vocab():
    with open(PATH, encoding="utf-8") as f:
        return bpe.Vocabulary(f.read())


def test_ids_and_texts_are_those_of_the_library(library, vocab):
    encoder = bpe.Encoder(vocab, kept=50)

    @settings(max_examples=300, deadline=None)
    @given(st.lists(TEXT, min_size=1, max_size=4))
    def check(texts):
        ids, bounds = encoder.encode(texts)
        for text, i, j in zip(texts, bounds, bounds[1:], strict=False):
            wanted = library.encode(text, add_special_tokens=False).ids
            assert ids[i:j].tolist() == wanted
            assert bpe.decoded(vocab, ids[i:j]) == library.decode(wanted, skip_special_tokens=False) == text

    check()


def test_runs_of_one_symbol(library, vocab):
    texts = ["a" * n for n in range(40)] + ["." * 301, " " * 77 + "x", "ab" * 500]
    ids, bounds = bpe.Encoder(vocab).encode(texts)
    for text, i, j in zip(texts, bounds, bounds[1:], strict=False):
        assert ids[i:j].tolist() == library.encode(text, add_special_tokens=False).ids


def test_cuts_do_not_change_pieces(vocab):
    text = "one  two\n\nthree  four ' it's  \t x" * 30
    assert "".join(bpe.stretches(text, 11)) == text
    whole = bpe.UNIT.findall(text)
    assert [u for part in bpe.stretches(text, 11) for u in bpe.UNIT.findall(part)] == whole
    assert [p for u in whole for p in vocab.pieces(u)] == vocab.pattern.findall(text)


def test_query_against_the_library(spark, library):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet").collect()
    found = {r["doc_id"]: r for r in queries.op3(spark, SMALL).collect()}
    assert len(found) == len(docs)
    for row in docs:
        ids = library.encode(row["text"] or "", add_special_tokens=False).ids
        r = found[row["doc_id"]]
        assert r["n_tokens"] == len(ids)
        assert r["ids_sha256"] == hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest()
        assert r["decoded_sha256"] == hashlib.sha256((row["text"] or "").encode()).hexdigest()


def test_odd_rows(odd):
    encoded = bpe.encode(odd, PATH)
    rows = bpe.decode(encoded, PATH).collect()
    assert len(rows) == 12 and all(r["decoded"] == (r["text"] or "") for r in rows)
    assert [list(r["ids"]) for r in rows if not r["text"]] == [[]] * 3
    again = bpe.round_trip(odd, PATH).collect()
    assert sorted(str(r["ids"]) for r in again) == sorted(str(r["ids"]) for r in rows)
    assert bpe.encode(odd.limit(0), PATH).count() == 0


def test_ids_that_are_no_tokens(rows):
    df = rows("ids array<int>", ([31373, -5, 999999999, None],), (None,), ([],), ([160],))
    assert [r["decoded"] for r in bpe.decode(df, PATH).collect()] == ["hello", None, "", "�"]
