from conftest import SMALL
from hypothesis import given, settings
from hypothesis import strategies as st
from shapes import documents, folder, odd  # noqa: F401

from tallyfold.llm import licenses as s
from tallyfold.llm import queries


def test_longest_rising():
    assert s.longest_rising([]) == [] and s.longest_rising([3]) == [0]
    values = [5, 1, 4, 2, 3, 9, 6, 7]
    assert [values[i] for i in s.longest_rising(values)] == [1, 2, 3, 6, 7]


@settings(max_examples=300, deadline=None)
@given(st.lists(st.integers(0, 5), max_size=12), st.lists(st.integers(0, 5), max_size=20))
def test_alignment_is_a_common_subsequence(ours, text):
    pairs = s.aligned(ours, text)
    assert all(ours[i] == text[j] for i, j in pairs)
    assert all(a < c and b < d for (a, b), (c, d) in zip(pairs, pairs[1:], strict=False))
    assert len(s.aligned(ours, ours)) == len(ours)


def test_gaps_are_aligned_with_what_becomes_unique_there():
    ours = "a x b x c".split()
    assert len(s.aligned(ours, "q a x b r x c".split())) == 5


def test_query_finds_every_notice(spark):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet").collect()
    found = {r["doc_id"]: r for r in queries.op4(spark, SMALL).collect()}
    assert len(found) == len(docs)
    for row in docs:
        wanted = {name for name, text in s.NOTICES if text in (row["text"] or "")}
        r = found[row["doc_id"]]
        assert wanted == {x["license_id"] for x in r["licenses"] if x["coverage"] == 1}
        assert (r["license_id"] in wanted) == bool(wanted)


def test_edited_wrapped_and_repeated_notices(documents):
    text = dict(s.NOTICES)["MIT-text"]
    edited = text.replace("merge, publish, ", "MERGE,\n  ").replace("hereby", "thereby")
    filler = "the of and to in software copy use " * 300
    docs = documents((1, filler + edited + filler), (2, (text + " ") * 5), (3, filler), (4, text[:len(text) // 2]),
                     (5, "x Licensed under the Apache License, Version 2.0. y Released under the MIT License."))
    found = {r["doc_id"]: r["licenses"] for r in s.scanned(docs).collect()}
    assert [x["license_id"] for x in found[1]] == ["MIT-text"] and 0.9 < found[1][0]["coverage"] < 1
    assert found[1][0]["start"] == 2400
    assert found[2][0]["coverage"] == 1 and not found[3] and not found[4]
    assert [(x["license_id"], x["words"]) for x in found[5]] == [("Apache-2.0", 8), ("MIT", 5)]
    assert (found[5][0]["start"], found[5][0]["stop"]) == (1, 9)


def test_odd_rows(odd):
    found = s.scanned(odd).collect()
    assert len(found) == 12 and not any(r["licenses"] for r in found)
    assert s.scanned(odd.limit(0)).count() == 0
    assert not any(r["licenses"] for r in s.scanned(odd, [("none", ""), ("null", None)]).collect())
