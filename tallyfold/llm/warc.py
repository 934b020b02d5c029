"""Web archives (WARC 1.1) in zstd frames: one frame a record, with the archive's own dictionary in front.

Writing:

1. The payload of a page is its html in UTF-8. Payloads are grouped by SHA-256; of equal ones of ``least`` bytes or
   more the page of the smallest id is a response and the others revisits of it, which carry headers only.
2. Pages are dealt into archives of about ``ARCHIVE_BYTES`` of payload, their number growing with the table. A
   payload with many copies is looked up by broadcast (there are few such) and its pages are dealt by a hash of their
   own; all others are dealt by their digest, so one shuffle serves the look-up and the archives.
3. Each task builds a Zstandard dictionary from the first records of its archive, writes it as a
   skippable frame (magic number 0x184D2A5D), then each record as a frame of its own. Frames are rows of Spark's text
   sink, so that its commit protocol holds for them, on any file system and with lost executors. What stands between two
   rows is an empty skippable frame, which every zstd reader passes over.

Reading takes whole archives, one at a time in a task, and checks each payload against its digest.

Defined cases: null and empty html is an empty payload. Records with a null page_id come after all
others; rows equal in page_id, url and html are records of one kind. A null url is written as ``urn:page:`` and the
id; white space and control characters in a url are percent-encoded. An archive too small to train a dictionary
on has none. Further columns of the pages are left out. An empty table gives no archive and no records.
"""

from __future__ import annotations

import datetime
import hashlib
import math
import re
import struct
import uuid
from collections.abc import Iterator

import pyarrow as pa
import zstandard
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyfold.session import materialize

#: Payload bytes of an archive, about; a task reads one at a time.
ARCHIVE_BYTES = 32 << 20
#: Payloads of fewer bytes are always written.
LEAST_BYTES = 100
#: Bytes of records that a dictionary is built from, and its size.
TRAINED_BYTES, DICTIONARY_BYTES = 4 << 20, 64 << 10
LEVEL = 3
#: A payload with more than this share of all pages is looked up by broadcast: there are at most 10,000.
HOT_SHARE = 1e-4
#: Compressed bytes given to the next step at once.
AT_ONCE = 8 << 20

#: Fixed values of the formats: magic numbers (little-endian), an empty skippable frame, the revisit profile.
DICTIONARY_MAGIC, SKIPPABLE = 0x184D2A5D, range(0x184D2A50, 0x184D2A60)
SEPARATOR = struct.pack("<II", 0x184D2A50, 0).decode("ascii")
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
SUFFIX = ".warc.zst"

_UNSAFE = re.compile("[\x00-\x20\x7f]")
_NAMES = uuid.UUID("6ba7b811-9dad-11d1-80b4-00c04fd430c8")


def _first() -> Column:
    """Order of pages of one payload: ids first, then urls."""
    return F.struct(F.col("page_id").isNull().alias("late"), "page_id", F.col("url").isNull().alias("none"), "url")


def record_plan(pages: DataFrame, least: int = LEAST_BYTES, archive_bytes: int = ARCHIVE_BYTES) -> DataFrame:
    """The pages as records: page_id, url, digest, size, record_type, refers_to, refers_url, payload.

    One partition is one archive. The payload of a revisit is null.
    """
    html = F.coalesce("html", F.lit(""))
    sized = pages.select(
        "page_id", "url", html.alias("html"), F.sha2(html, 256).alias("digest"),
        F.octet_length(html).cast("long").alias("size"))
    facts = materialize(sized.drop("html"), "payloads")
    rows, total = facts.agg(F.count("*"), F.coalesce(F.sum("size"), F.lit(0))).first()
    repeated = facts.filter(F.col("size") >= least).groupBy("digest").agg(
        F.min(_first()).alias("first"), F.count("*").alias("n")).filter("n > 1")
    repeated = materialize(repeated, "repeated")
    hot = repeated.filter(F.col("n") > rows * HOT_SHARE).select("digest", F.col("first").alias("hot_first"))
    other = repeated.filter(F.col("n") <= rows * HOT_SHARE).select(
        F.col("digest").alias("deal"), F.col("first").alias("other_first"))
    archives = max(1, math.ceil(total / archive_bytes))
    own = F.concat(F.lit("#"), F.xxhash64("page_id", "url", F.monotonically_increasing_id()))
    left = sized.join(F.broadcast(hot), "digest", "left")
    left = _marked(left, "hot_first").withColumn(
        "deal", F.when(F.col("hot_first").isNull(), F.col("digest")).otherwise(own))
    joined = left.repartition(archives, "deal").join(
        other.repartition(archives, "deal").hint("shuffle_hash"), "deal", "left")
    first = F.coalesce("hot_first", "other_first")
    marked = _marked(joined.withColumn("hot_first", first), "hot_first")
    kind = F.when(F.col("html").isNull(), "revisit").otherwise("response")
    target = F.when(F.col("html").isNull(), F.col("hot_first"))
    return marked.select(
        "page_id", "url", "digest", "size", kind.alias("record_type"), target["page_id"].alias("refers_to"),
        target["url"].alias("refers_url"), F.encode("html", "UTF-8").alias("payload"))


def _marked(rows: DataFrame, first: str) -> DataFrame:
    """Rows without the html where the page is not the first of its payload."""
    later = F.col(first).isNotNull() & (_first() != F.col(first))
    return rows.withColumn("html", F.when(~later, F.col("html")))


def _uri(page_id: int | None, url: str | None) -> str:
    return f"urn:page:{'' if page_id is None else page_id}" if url is None else _UNSAFE.sub(
        lambda m: f"%{ord(m.group()):02X}", url)


def _record_id(page_id: int | None, url: str | None) -> str:
    return f"<urn:uuid:{uuid.uuid5(_NAMES, f'{page_id} {_uri(page_id, url)}')}>"


def _headers(*pairs: tuple[str, object]) -> str:
    return "".join(f"{name}: {value}\r\n" for name, value in pairs if value is not None)


def record_bytes(row: dict, date: str) -> bytes:
    """One record of ``record_plan``: its headers, the HTTP headers of the page, and the payload of a response."""
    page_id, url, payload = row["page_id"], row["url"], row["payload"]
    http = "HTTP/1.1 200 OK\r\n" + _headers(
        ("Content-Type", "text/html; charset=utf-8"), ("Content-Length", row["size"])) + "\r\n"
    block = http.encode() + (payload or b"")
    refers = {} if payload is not None else {
        "WARC-Profile": PROFILE, "WARC-Refers-To": _record_id(row["refers_to"], row["refers_url"]),
        "WARC-Refers-To-Target-URI": _uri(row["refers_to"], row["refers_url"]), "WARC-Refers-To-Page": row["refers_to"]}
    head = "WARC/1.1\r\n" + _headers(
        ("WARC-Type", row["record_type"]), ("WARC-Record-ID", _record_id(page_id, url)), ("WARC-Date", date),
        ("WARC-Target-URI", _uri(page_id, url)), ("WARC-Page-ID", page_id),
        ("WARC-Payload-Digest", f"sha256:{row['digest']}"), *refers.items(),
        ("Content-Type", "application/http; msgtype=response"), ("Content-Length", len(block)))
    return head.encode() + b"\r\n" + block + b"\r\n\r\n"


def _dictionary(records: list[bytes]) -> zstandard.ZstdCompressionDict | None:
    """A dictionary of the records; None where there is too little to learn from."""
    try:
        made = zstandard.train_dictionary(DICTIONARY_BYTES, records)
    except zstandard.ZstdError:
        return None
    made.precompute_compress(level=LEVEL)
    return made


def frames(records: Iterator[bytes], trained_bytes: int = TRAINED_BYTES) -> Iterator[bytes]:
    """The frames of one archive: the dictionary, then every record."""
    held, size = [], 0
    for record in records:
        held.append(record)
        size += len(record)
        if size >= trained_bytes:
            break
    made = _dictionary(held)
    if made is not None:
        raw = made.as_bytes()
        yield struct.pack("<II", DICTIONARY_MAGIC, len(raw)) + raw
    packer = zstandard.ZstdCompressor(level=LEVEL, dict_data=made, write_checksum=True)
    yield from map(packer.compress, held)
    held.clear()
    yield from map(packer.compress, records)


def write_archives(pages: DataFrame, path: str, date: datetime.datetime, least: int = LEAST_BYTES,
                   archive_bytes: int = ARCHIVE_BYTES) -> None:
    """Writes the pages below ``path`` as archives named ``….warc.zst``. ``date``: WARC-Date of all records."""
    stamp = date.strftime("%Y-%m-%dT%H:%M:%SZ")
    planned = record_plan(pages, least, archive_bytes)

    def records(batches: Iterator[pa.RecordBatch]) -> Iterator[bytes]:
        for batch in batches:
            for i in range(len(batch)):
                yield record_bytes(batch.slice(i, 1).to_pylist()[0], stamp)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size = [], 0
        for frame in frames(records(batches)):
            held.append(frame)
            size += len(frame)
            if size >= AT_ONCE:
                yield pa.RecordBatch.from_arrays([pa.array(held, pa.binary())], names=["frame"])
                held, size = [], 0
        if held:
            yield pa.RecordBatch.from_arrays([pa.array(held, pa.binary())], names=["frame"])

    # The sink writes the bytes of a string as they are.
    planned.mapInArrow(run, "frame binary").select(F.col("frame").cast("string").alias("value")).write.option(
        "lineSep", SEPARATOR).option("compression", "none").text(path)
    _rename(pages.sparkSession, path)


def _rename(spark: SparkSession, path: str) -> None:
    """Gives the files of a finished write the ending of such archives; one metadata call a file."""
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    fs = folder.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf())
    for status in fs.listStatus(folder):
        name = status.getPath().getName()
        if name.startswith("part-") and status.getLen():
            target = spark._jvm.org.apache.hadoop.fs.Path(folder, name.split("-c0")[0].removesuffix(".txt") + SUFFIX)
            fs.rename(status.getPath(), target)


FIELDS = (
    "archive string, offset long, record_type string, record_id string, page_id long, url string, "
    "payload_bytes long, payload_digest string, refers_to long, intact boolean, payload binary"
)


def split_frames(data: bytes) -> Iterator[tuple[int, bytes]]:
    """Offset and content of every record of an archive."""
    view, at, opener = memoryview(data), 0, zstandard.ZstdDecompressor()
    while at < len(view):
        magic, size = struct.unpack_from("<II", view, at)
        if magic in SKIPPABLE:
            if magic == DICTIONARY_MAGIC and at == 0:
                known = zstandard.ZstdCompressionDict(bytes(view[8:8 + size]))
                opener = zstandard.ZstdDecompressor(dict_data=known)
            at += 8 + size
            continue
        one, parts, start, step = opener.decompressobj(), [], at, 1 << 11
        while not one.eof:
            if at >= len(view):
                raise ValueError(f"the frame at {start} is cut off")
            parts.append(one.decompress(view[at:at + step]))
            at, step = at + step, step * 2
        at = min(at, len(view)) - len(one.unused_data)
        yield start, b"".join(parts)


def parsed(record: bytes) -> dict:
    """Headers of a record, of the page in it, and its payload (None: a revisit)."""
    head, _, rest = record.partition(b"\r\n\r\n")
    named = dict(line.split(": ", 1) for line in head.decode().split("\r\n")[1:])
    block = rest[:int(named["Content-Length"])]
    http, _, body = block.partition(b"\r\n\r\n")
    named |= {f"HTTP {k}": v for k, v in (x.split(": ", 1) for x in http.decode().split("\r\n")[1:])}
    return named | {"payload": body if named["WARC-Type"] == "response" else None}


def read_archives(spark: SparkSession, path: str, payloads: bool = True) -> DataFrame:
    """The records of all archives below ``path``, as FIELDS.

    ``payload_bytes`` and ``payload_digest`` of a response are those of the payload read; ``intact``: they are as its
    headers say. Those of a revisit are its headers'. Without ``payloads`` that column is null.
    """

    def row(archive: str, offset: int, record: bytes) -> dict:
        found = parsed(record)
        body, said = found["payload"], found["WARC-Payload-Digest"].removeprefix("sha256:")
        size, digest = int(found["HTTP Content-Length"]), said
        if body is not None:
            size, digest = len(body), hashlib.sha256(body).hexdigest()
        number = {k: int(v) for k in ("WARC-Page-ID", "WARC-Refers-To-Page") if (v := found.get(k)) is not None}
        return {
            "archive": archive, "offset": offset, "record_type": found["WARC-Type"],
            "record_id": found["WARC-Record-ID"], "page_id": number.get("WARC-Page-ID"), "url": found["WARC-Target-URI"],
            "payload_bytes": size, "payload_digest": digest, "refers_to": number.get("WARC-Refers-To-Page"),
            "intact": digest == said and str(size) == found["HTTP Content-Length"],
            "payload": body if payloads else None}

    schema = pa.schema([
        (name, {"string": pa.string(), "long": pa.int64(), "boolean": pa.bool_(), "binary": pa.binary()}[kind])
        for name, kind in (field.split() for field in FIELDS.split(", "))])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(len(batch)):
                held, size = [], 0
                archive = batch.column(0)[i].as_py().rsplit("/", 1)[-1]
                for offset, record in split_frames(batch.column(1)[i].as_py()):
                    held.append(row(archive, offset, record))
                    size += len(record)
                    if size >= AT_ONCE:
                        yield pa.RecordBatch.from_pylist(held, schema)
                        held, size = [], 0
                yield pa.RecordBatch.from_pylist(held, schema)

    files = spark.read.format("binaryFile").option("pathGlobFilter", f"*{SUFFIX}").load(path)
    return files.select("path", "content").mapInArrow(run, FIELDS)
