import random
import time
from collections import Counter

from conftest import SMALL
from shapes import LONG, documents, folder, odd  # noqa: F401

from tallyfold.llm import line_dedup as d
from tallyfold.llm import queries


def brute(docs):
    """Texts in order of id, read line by line; shares no code with the operator.

    Of each pair of neighbouring lines (blank ones between them aside) and each line of 50 words only the
    first place stays. A pair that overlaps an equal one stands for its three lines.
    """
    seen, out = set(), {}
    for doc, text in sorted(docs, key=lambda x: x[0]):
        lines = (text or "").split("\n")
        full = [i for i, line in enumerate(lines) if line.strip()]
        blocks = [(i, i) for i in full if len(lines[i].split()) >= 50]
        runs = 0
        for a, b, c in zip([None, *full], full, full[1:]):
            again = a is not None and lines[a:b + 1] == lines[b:c + 1]
            runs = runs + 1 if again else 0
            blocks.append((a, c) if runs == 1 else (b, c))
        if len(full) > 1:
            blocks += [(0, full[1]), (full[-2], len(lines) - 1)]
        gone = set()
        for a, b in sorted(set(blocks)):
            block = tuple(lines[a:b + 1])
            if block in seen:
                gone.update(range(a, b + 1))
            seen.add(block)
        out[doc] = None if text is None else "\n".join(x for i, x in enumerate(lines) if i not in gone)
    return out


def shown(texts):
    """Without blank lines, of which chunks may take more."""
    return {doc: None if t is None else [x for x in t.split("\n") if x.strip()] for doc, t in texts.items()}


def test_query_against_brute_force(spark):
    docs = [(r["doc_id"], r["text"]) for r in spark.read.parquet(f"{SMALL}/documents.parquet").collect()]
    found = queries.op8(spark, SMALL).collect()
    assert shown({r["doc_id"]: r["text"] for r in found}) == shown(brute(docs))
    assert sum(bool(r["removed"]) for r in found) > 5


def test_random_lines_against_brute_force(spark, documents):
    draw = random.Random(5)
    parts = [[f"s{k}-{i}" for i in range(draw.randint(2, 40))] for k in range(12)]

    def text():
        lines = []
        for _ in range(draw.randint(0, 6)):
            part = draw.choice(parts)
            at = draw.randrange(len(part))
            lines += [*part[at:at + draw.randint(1, 40)], *draw.choice([[], [f"o{draw.random()}"], ["", "z"], ["z"] * 4])]
        return "\n".join(lines)

    docs = [(i, text()) for i in range(60)]
    found = {r["doc_id"]: r["text"] for r in d.without_repeated_lines(documents(*docs)).collect()}
    assert shown(found) == shown(brute(docs))


def test_chunks_settle_most_of_a_long_repeat(spark, documents):
    """Chunks are the seeds: what is inside their copies is not compared again, only what lies around them."""
    lines = [f"line {i * 7919 % 1000}" for i in range(400)]
    docs = documents((1, "\n".join(["a", *lines])), (2, "\n".join(["b", "c", *lines, "d"])))
    left = d.open_places(d.blocks(docs.withColumn("_row", docs.doc_id))).collect()
    chunks = list(d.line_chunks([x.encode() for x in lines]))
    runs = sum(r["end"] - r["start"] == 2 and r["doc_id"] == 2 for r in left)
    assert runs < len(lines) - len(chunks) and len([r for r in left if r["doc_id"] == 2]) < 2.1 * len(chunks) + 10


def test_boundaries_do_not_shift():
    lines = [f"line {i * 7919 % 1000}".encode() for i in range(400)]
    chunks = {b"\n".join(lines[i:j]) for i, j in d.line_chunks(lines)}
    shifted = [b"new", *lines[:200], b"other", *lines[200:]]
    again = {b"\n".join(shifted[i:j]) for i, j in d.line_chunks(shifted)}
    assert len(chunks & again) >= 0.9 * len(chunks)


def test_chunks_cover_all_lines():
    for lines in ([], [b""], [b"a"], [b"same"] * 500, [str(i).encode() for i in range(99)]):
        spans = list(d.line_chunks(lines))
        assert [i for s, e in spans for i in range(s, e)] == list(range(len(lines)))
        assert all(2 <= e - s <= 64 for s, e in spans[:-1])


def test_shared_block_stays_once(documents):
    block = "\n".join(f"shared line {i}" for i in range(40))
    docs = [(i, f"own {i}\nmore {i}\nand {i}\n{block}\ntail {i}\nend {i}") for i in range(30)]
    found = {r["doc_id"]: r["text"] for r in d.without_repeated_lines(documents(*docs)).collect()}
    assert found == brute(docs) and found[0] == docs[0][1]
    kept = Counter(line for i, t in found.items() if i for line in t.split("\n") if line.startswith("shared"))
    assert kept.total() <= 0.2 * 29 * 40
    assert all(f"own {i}" in t and f"end {i}" in t for i, t in found.items())


def test_equal_hashes_of_other_bytes_stay(documents, monkeypatch):
    monkeypatch.setattr(d, "_hash", lambda raw: 1)
    docs = [(1, "a\nb\nc\nd"), (2, "e\nf\ng\nh"), (3, "a\nb\nc\nd")]
    # The workers of the test session import the module anew, so the clash is made in the table.
    rows = documents(*docs)
    found = {r["doc_id"]: r["text"] for r in d.without_repeated_lines(rows).collect()}
    assert found == brute(docs)


def test_odd_rows(odd):
    found = d.without_repeated_lines(odd)
    assert set(odd.columns) == set(found.columns)
    rows = found.collect()
    assert len(rows) == 12
    texts = {r["doc_id"]: r["text"] for r in rows if r["doc_id"] is not None}
    assert texts[1] is None and texts[2] == "" and texts[4] == LONG and texts[8] == "a\nb\nc\nd\ne\nf"
    assert texts[9] == brute([(8, texts[8]), (9, texts[8])])[9] != texts[8]
    assert d.without_repeated_lines(odd.limit(0)).count() == 0


def test_short_blocks_go_wherever_they_stand(documents):
    """Each line of a run of 2 to 8 lines that stands in an earlier text, between other lines."""
    def block(n):
        return [f"block {n} line {k}" for k in range(n)]

    docs = [(i * 10 + n, "\n".join([f"a{i} {n}", f"b{i} {n}", *block(n), f"c{i} {n}", f"d{i} {n}"]))
            for i in range(3) for n in range(2, 9)]
    found = {r["doc_id"]: r["text"] for r in d.without_repeated_lines(documents(*docs)).collect()}
    for i in range(3):
        for n in range(2, 9):
            own = [f"a{i} {n}", f"b{i} {n}", *(block(n) if i == 0 else []), f"c{i} {n}", f"d{i} {n}"]
            assert found[i * 10 + n] == "\n".join(own)


def test_long_single_lines_go(documents):
    long, short = " ".join(f"w{k}" for k in range(50)), " ".join(f"w{k}" for k in range(49))
    docs = [(1, f"a\n{long}\nb"), (2, f"c\n{long}\nd"), (3, long), (4, f"e\n{short}\nf"), (5, f"g\n{short}\nh")]
    found = {r["doc_id"]: r["text"] for r in d.without_repeated_lines(documents(*docs)).collect()}
    assert found == {**dict(docs), 2: "c\nd", 3: ""}
    found = {r["doc_id"]: r["text"] for r in d.without_repeated_lines(documents(*docs), one_line=False).collect()}
    assert found == {**dict(docs), 2: "c\nd"}


def test_first_places_stay_and_blank_ends_go(documents):
    docs = [(1, "x\nx\nx"), (2, "x\nx\nx\nx\nx"), (3, "y\nx\nx\nx\nz"),
            (4, "\np\n\nq\n\n"), (5, "\np\n\nq\n\n"), (6, "r\np\n\nq\ns"), (7, "t\nt\nt\nt")]
    found = {r["doc_id"]: r["text"] for r in d.without_repeated_lines(documents(*docs)).collect()}
    assert found == {**dict(docs), 2: "", 3: "y\nz", 5: "", 6: "r\ns", 7: "t\nt"}


def test_long_repeated_documents_take_linear_time(documents):
    """Two equal documents: all lines of the second go, in about twice the time for twice the lines."""
    took = []
    for n in (8_000, 8_000, 32_000):
        text = "\n".join(f"line {i} of a long log" for i in range(n))
        start = time.perf_counter()
        rows = {r["doc_id"]: r["text"] for r in d.without_repeated_lines(documents((1, text), (2, text))).collect()}
        took.append(time.perf_counter() - start)
        assert rows == {1: text, 2: ""}
    assert took[2] < 3 * took[1] + 3
