import datetime
import hashlib
import io
import struct

import pytest
import zstandard
from conftest import SMALL
from shapes import folder  # noqa: F401

from tallyfold.llm import queries, warc

SCHEMA = "page_id long, url string, html string, payload string, digest int, size string, archive string"
DAY = datetime.datetime(2024, 1, 1)
BODY = "<html><body><p>{}</p>" + "<div>menu home news about contact</div>" * 6 + "</body></html>"


def page(page_id, url, html):
    return (page_id, url, html, "own", 1, "own", "own")


def written(spark, path, pages, **more):
    warc.write_archives(pages, str(path), DAY, **more)
    return warc.read_archives(spark, str(path))


def plan(pages, least=100):
    """(type, refers_to) of every row, by plain grouping."""
    groups = {}
    for page_id, url, html in pages:
        groups.setdefault(html or "", []).append((page_id is None, page_id or 0, url is None, url or ""))
    out = []
    for page_id, url, html in pages:
        first = min(groups[html or ""])
        later = len((html or "").encode()) >= least and (page_id is None, page_id or 0, url is None, url or "") != first
        out.append(("revisit", None if first[0] else first[1]) if later else ("response", None))
    return out


PAGES = [
    (5, "https://a.example/5", BODY.format("one")), (3, "https://a.example/3", BODY.format("one")),
    (9, None, BODY.format("one")), (4, "https://a.example/4", "short"), (6, "https://a.example/6", "short"),
    (7, "https://a.example/ü?q=%20", BODY.format("Ünï 日本 \x00\r\n\r\nWARC/1.1")), (8, "bad\r\nurl x", None), (10, "u", ""),
    (None, "n2", BODY.format("two")), (None, "n1", BODY.format("two")), (None, None, None),
    (11, "twin", BODY.format("three")), (11, "twin", BODY.format("three")), (12, "twin", BODY.format("three")),
    *[(100 + i, f"https://b.example/{i}", BODY.format(f"page {i} {i * i}" * 20)) for i in range(300)],
    (13, "edge", "é" * 50), (14, "edge", "é" * 50), (15, "under", "e" * 99), (16, "under", "e" * 99),
]


def facts(pages):
    return sorted([(
        p, len((h or "").encode()), hashlib.sha256((h or "").encode()).hexdigest(), kind, to)
        for (p, _, h), (kind, to) in zip(pages, plan(pages), strict=True)], key=repr)


@pytest.mark.parametrize("archive_bytes", [32 << 20, 20_000])
def test_round_trip(spark, rows, tmp_path, archive_bytes):
    df = rows(SCHEMA, *[page(*p) for p in PAGES]).repartition(3)
    read = written(spark, tmp_path / "w", df, archive_bytes=archive_bytes)
    found = read.collect()
    assert all(r["intact"] for r in found)
    assert sorted([(r["page_id"], r["payload_bytes"], r["payload_digest"], r["record_type"], r["refers_to"])
                   for r in found], key=repr) == facts(PAGES)
    html = {(p, u): h or "" for p, u, h in PAGES}
    for r in found:
        if r["record_type"] == "response" and r["url"] in {u for _, u in html}:
            assert bytes(r["payload"]) == html[r["page_id"], r["url"]].encode()
        if r["record_type"] == "revisit":
            assert r["payload"] is None
    assert len({r["archive"] for r in found}) == (1 if archive_bytes > 1 << 20 else len({r["archive"] for r in found}))
    assert (len({r["archive"] for r in found}) > 3) == (archive_bytes == 20_000)


def test_hot_and_rare_copies_alike(spark, rows, tmp_path, monkeypatch):
    df = rows(SCHEMA, *[page(*p) for p in PAGES])
    monkeypatch.setattr(warc, "HOT_SHARE", 0.5)
    read = written(spark, tmp_path / "w", df, archive_bytes=30_000).collect()
    assert sorted([(r["page_id"], r["payload_bytes"], r["payload_digest"], r["record_type"], r["refers_to"])
                   for r in read], key=repr) == facts(PAGES)


def test_archives_open_with_the_plain_library(spark, rows, tmp_path):
    """The file is zstd to any reader that takes the dictionary from the first frame; each record is one frame."""
    written(spark, tmp_path / "w", rows(SCHEMA, *[page(*p) for p in PAGES])).count()
    (file,) = (tmp_path / "w").glob(f"*{warc.SUFFIX}")
    raw = file.read_bytes()
    magic, size = struct.unpack_from("<II", raw)
    assert magic == 0x184D2A5D and raw[8:12] == bytes.fromhex("37a430ec")
    opener = zstandard.ZstdDecompressor(dict_data=zstandard.ZstdCompressionDict(raw[8:8 + size]))
    whole = opener.stream_reader(io.BytesIO(raw), read_across_frames=True).read()
    assert whole == b"".join(record for _, record in warc.split_frames(raw))
    assert whole.count(b"WARC/1.1\r\nWARC-Type: ") == len(PAGES)
    plain = sum(len(zstandard.compress(record)) for _, record in warc.split_frames(raw))
    assert len(raw) - size < plain


def test_records_are_found_by_offset(spark, rows, tmp_path):
    found = written(spark, tmp_path / "w", rows(SCHEMA, *[page(*p) for p in PAGES])).collect()
    (file,) = (tmp_path / "w").glob(f"*{warc.SUFFIX}")
    by_offset = dict(warc.split_frames(file.read_bytes()))
    for r in found:
        head = warc.parsed(by_offset[r["offset"]])
        assert head["WARC-Record-ID"] == r["record_id"] and head["WARC-Target-URI"] == r["url"]
    ids = {(r["page_id"], r["url"]): r["record_id"] for r in found}
    for r in found:
        if r["page_id"] == 5:
            assert warc.parsed(by_offset[r["offset"]])["WARC-Refers-To"] == ids[3, "https://a.example/3"]


def test_a_broken_archive_is_noticed(spark, rows, tmp_path):
    records = [warc.record_bytes({
        "page_id": i, "url": "u", "payload": b"x" * 40, "size": 40, "record_type": "response",
        "digest": hashlib.sha256(b"y" if i == 2 else b"x" * 40).hexdigest(), "refers_to": None, "refers_url": None,
    }, "2024-01-01T00:00:00Z") for i in range(4)]
    data = b"".join(warc.frames(iter(records)))
    assert [r for _, r in warc.split_frames(data)] == records
    with pytest.raises(ValueError, match="cut off"):
        list(warc.split_frames(data[:-3]))
    (tmp_path / f"a{warc.SUFFIX}").write_bytes(data)
    read = warc.read_archives(spark, str(tmp_path), payloads=False).orderBy("page_id").collect()
    assert [r["intact"] for r in read] == [True, True, False, True] and read[0]["payload"] is None


def test_odd_tables(spark, rows, tmp_path, folder):
    assert written(spark, tmp_path / "e", rows(SCHEMA)).count() == 0
    long = page(1, "u", "<p>" + "many words " * 200_000)
    read = written(spark, tmp_path / "l", rows(SCHEMA, long, long, page(None, None, None))).collect()
    assert sorted(r["payload_bytes"] for r in read) == [0, len(long[2]), len(long[2])]
    assert {r["record_type"] for r in read} == {"response"}


def test_query_returns_every_page(spark):
    pages = spark.read.parquet(f"{SMALL}/pages.parquet")
    assert queries.op12(spark, SMALL).count() == pages.count()
