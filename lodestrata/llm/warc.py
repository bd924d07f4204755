"""Web archives: write page captures as WARC records, read them, assemble transactions.

A capture is three records: the request, the response (or a revisit, where an
equal payload is already stored) and the metadata, which name the capture in
``WARC-Concurrent-To``.  Reading parses records by their content length, checks
payloads against their digests and joins the three kinds through the
concurrent-to identifiers into one nested row per capture.
"""

from __future__ import annotations

import hashlib
import uuid
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lodestrata.llm.common import open_store, stored, write_file
from lodestrata.session import fresh_dir

LEAST_PAYLOAD = 100      # bytes from which an equal payload becomes a revisit
FILE_BYTES = 64 << 20    # bytes of records after which a file is closed
READ_BYTES = 1 << 20     # bytes of a file that are read at once
LEVEL = 4                # of the compression
WHEN = "2024-01-01T00:00:00Z"

# Fixed values of the format.
VERSION = b"WARC/1.1"
REVISIT_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
CAPTURES = ("response", "revisit", "resource")

RECORD = pa.schema([
    ("record_id", pa.string()), ("record_type", pa.string()), ("target_uri", pa.string()),
    ("warc_date", pa.string()), ("concurrent_to", pa.list_(pa.string())),
    ("refers_to", pa.string()), ("head", pa.string()), ("payload_bytes", pa.int64()),
    ("payload_digest", pa.string()), ("payload", pa.binary()),
])
RECORD_DDL = (
    "record_id string, record_type string, target_uri string, warc_date string, "
    "concurrent_to array<string>, refers_to string, head string, payload_bytes long, "
    "payload_digest string, payload binary"
)


def _record(headers: list[tuple[str, str]], block: bytes) -> bytes:
    """One record, compressed on its own."""
    lines = [VERSION] + [f"{k}: {v}".encode() for k, v in headers]
    lines += [b"Content-Length: %d" % len(block), b"", block, b"", b""]
    packer = zlib.compressobj(LEVEL, zlib.DEFLATED, 31)
    return packer.compress(b"\r\n".join(lines)) + packer.flush()


def _header_text(url: str) -> str:
    """A URL that fits a header line: white space and control signs are percent-encoded."""
    return "".join(x if x > " " and x != "\x7f" else f"%{ord(x):02X}" for x in url)


def record_name(page_id, url, digest, kind: str) -> str:
    """The same identifier whenever the record is written again."""
    return f"<urn:uuid:{uuid.UUID(bytes=hashlib.md5(repr((page_id, url, digest, kind)).encode()).digest())}>"


def _capture(row: dict) -> list[bytes]:
    page, url, digest, html = row["page_id"], row["url"], row["digest"], row["html"] or ""
    body = html.encode()
    name = {x: record_name(page, url, digest, x) for x in ("request", "capture", "metadata")}
    place = [("WARC-Date", WHEN)]
    uri = _header_text(url) if url else ""
    if uri:
        place.append(("WARC-Target-URI", uri))
    head = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(body)}\r\n\r\n"
    host, _, path = uri.partition("://")[2].partition("/")
    concurrent = ("WARC-Concurrent-To", name["capture"])
    about = [
        ("WARC-Record-ID", name["capture"]), *place, ("WARC-Payload-Digest", f"sha256:{digest}"),
        ("Content-Type", "application/http; msgtype=response"),
    ]
    if row["refers_to"] is None:
        capture = _record([("WARC-Type", "response"), *about], head.encode() + body)
    else:
        first = record_name(row["refers_to"], row["first_url"], digest, "capture")
        capture = _record([
            ("WARC-Type", "revisit"), *about, ("WARC-Refers-To", first),
            ("WARC-Profile", REVISIT_PROFILE),
        ], head.encode())
    request = f"GET /{path} HTTP/1.1\r\nHost: {host}\r\n\r\n".encode()
    fields = b"" if page is None else b"page-id: %d\r\n" % page
    return [
        _record([("WARC-Type", "request"), ("WARC-Record-ID", name["request"]), *place, concurrent,
                 ("Content-Type", "application/http; msgtype=request")], request),
        capture,
        _record([("WARC-Type", "metadata"), ("WARC-Record-ID", name["metadata"]), *place, concurrent,
                 ("Content-Type", "application/warc-fields")], fields),
    ]


def with_revisits(pages: DataFrame, least: int = LEAST_PAYLOAD) -> DataFrame:
    """Pages with ``digest`` and, where an equal payload has a smaller id, ``refers_to``.

    Firsts are found by a plain aggregate over digests, and joined back, so a
    payload that a third of the pages share is combined before the shuffle and
    split in the join.  Null html is an empty payload; a page without an id
    never comes first; rows that repeat the first id are responses, too.
    """
    body = F.coalesce(F.col("html"), F.lit(""))
    known = pages.select(
        F.col("page_id").cast("long").alias("page_id"), "url", body.alias("html"),
        F.sha2(body.cast("binary"), 256).alias("digest"),
    )
    firsts = (
        known.filter((F.octet_length("html") >= least) & F.col("page_id").isNotNull())
        .groupBy("digest").agg(
            F.min(F.struct("page_id", "url")).alias("first"), F.count("*").alias("n"))
        .filter("n > 1").select("digest", "first")
    )
    later = F.col("first.page_id") < F.col("page_id")
    later = F.coalesce(later, F.col("first.page_id").isNotNull())
    return known.join(firsts, "digest", "left").select(
        "page_id", "url", "html", "digest",
        F.when(later, F.col("first.page_id")).alias("refers_to"),
        F.when(later, F.col("first.url")).alias("first_url"),
    )


def write_archives(pages: DataFrame, folder: str, file_bytes: int = FILE_BYTES) -> DataFrame:
    """Write a capture for each row of ``with_revisits``; returns ``file records``.

    Each task writes files of about ``file_bytes`` bytes of records, its rows in order of digest, id and
    address; so a repeated task cuts the files at the same rows and writes them again under the same names.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        part, number, held, parts = TaskContext.get().partitionId(), 0, 0, []

        def flush() -> pa.RecordBatch:
            name = f"{part:08d}-{number:06d}.warc.gz"
            write_file(f"{folder}/{name}", parts)
            return pa.RecordBatch.from_pydict({"file": [name], "records": [len(parts)]})

        for batch in batches:
            for row in batch.to_pylist():
                parts += _capture(row)
                held += len(row["html"] or "")
                if held >= file_bytes:
                    yield flush()
                    number, held, parts = number + 1, 0, []
        if parts:
            yield flush()

    ordered = pages.sortWithinPartitions("digest", "page_id", "url")
    return stored(ordered.mapInArrow(run, "file string, records long"), "archives")


# ------------------------------------------------------------------- reading


class _Stream:
    """The inflated bytes of a file of compressed records (or of a plain one)."""

    def __init__(self, file):
        self._file, self._held, self._inflate = file, bytearray(), None
        self._raw = file.read(READ_BYTES)
        self._plain = not self._raw.startswith(b"\x1f\x8b")

    def _more(self) -> bool:
        if not self._raw:
            self._raw = self._file.read(READ_BYTES)
            if not self._raw:
                return False
        if self._plain:
            self._held += self._raw
            self._raw = b""
            return True
        if self._inflate is None:
            self._inflate = zlib.decompressobj(31)
        self._held += self._inflate.decompress(self._raw)
        self._raw = self._inflate.unused_data
        if self._inflate.eof:
            self._inflate = None
        return True

    def until(self, mark: bytes) -> bytes | None:
        """What comes before the mark, or None at the end."""
        seen = 0
        while (at := self._held.find(mark, seen)) < 0:
            seen = max(0, len(self._held) - len(mark))
            if not self._more():
                if self._held.strip():
                    raise ValueError("a record is cut off")
                return None
        found = bytes(self._held[:at])
        del self._held[: at + len(mark)]
        return found

    def take(self, size: int) -> bytes:
        while len(self._held) < size:
            if not self._more():
                raise ValueError("a record is cut off")
        found = bytes(self._held[:size])
        del self._held[:size]
        return found


def _parsed(head: bytes, stream: _Stream, keep: bool) -> tuple:
    lines = head.lstrip(b"\r\n").decode("utf-8", "replace").split("\r\n")
    if not lines[0].startswith("WARC/"):
        raise ValueError("not a WARC record")
    single, concurrent = {}, []
    for line in lines[1:]:
        key, _, value = line.partition(":")
        key, value = key.strip().lower(), value.strip()
        if key == "warc-concurrent-to":
            concurrent.append(value)
        else:
            single[key] = value
    block = stream.take(int(single["content-length"]))
    kind, text, payload = single.get("warc-type"), "", block
    if single.get("content-type", "").startswith("application/http"):
        first, _, payload = block.partition(b"\r\n\r\n")
        text = first.decode("utf-8", "replace")
    elif kind == "metadata":
        text, payload = block.decode("utf-8", "replace"), b""
    size, digest = len(payload), hashlib.sha256(payload).hexdigest()
    noted = single.get("warc-payload-digest", "")
    if kind == "revisit":
        # Of the whole payload, which another record holds.
        lengths = [x.partition(":")[2] for x in text.split("\r\n") if x.lower().startswith("content-length:")]
        size, digest = int(lengths[0]) if lengths else None, noted.removeprefix("sha256:")
    elif noted.startswith("sha256:") and noted != f"sha256:{digest}":
        raise ValueError(f"{single.get('warc-record-id')}: the payload doesn't match its digest")
    return (
        single.get("warc-record-id"), kind, single.get("warc-target-uri"), single.get("warc-date"),
        concurrent, single.get("warc-refers-to"), text, size, digest,
        payload if keep and kind not in ("revisit", "metadata") else None,
    )


def read_archives(
    spark: SparkSession, folder: str, files: list[str], payload: bool = True,
) -> DataFrame:
    """The records of WARC files, plain or with each record compressed.

    A file is read in pieces and inflated record by record, so a task holds a
    few records at a time.  ``payload=False`` leaves the bytes out after their
    digest has been taken and compared.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for name in batch["file"].to_pylist():
                store, path = open_store(f"{folder}/{name}")
                rows, held = [], 0
                with store.open_input_stream(path, compression=None) as file:
                    stream = _Stream(file)
                    while (head := stream.until(b"\r\n\r\n")) is not None:
                        if not head.strip():
                            continue
                        rows.append(_parsed(head, stream, payload))
                        held += len(rows[-1][-1] or b"") + 200
                        if held > 8 << 20 or len(rows) >= 2048:
                            yield _batch(rows)
                            rows, held = [], 0
                if rows:
                    yield _batch(rows)

    def _batch(rows: list[tuple]) -> pa.RecordBatch:
        columns = zip(*rows)
        return pa.RecordBatch.from_arrays(
            [pa.array(x, k.type) for x, k in zip(columns, RECORD)], schema=RECORD
        )

    listed = spark.createDataFrame([(x,) for x in files], "file string")
    return listed.repartition(max(1, len(files))).mapInArrow(run, RECORD_DDL)


def assemble(records: DataFrame) -> DataFrame:
    """One nested row per capture, with its request and metadata.

    A request or metadata record belongs to the capture that it names in
    concurrent-to, or that names it.  Several requests (or metadata records) of
    a capture are counted and the one with the least identifier is given.  A
    capture without them has nulls there; records that belong to no capture
    give no row.  ``records`` is read several times, so pass a stored table.
    """
    captures = records.filter(F.col("record_type").isin(*CAPTURES))
    sides = records.filter(F.col("record_type").isin("request", "metadata")).select(
        "record_id", "record_type", "head", "warc_date", "concurrent_to"
    )
    named = sides.select(F.explode("concurrent_to").alias("capture"), *sides.columns[:-1])
    naming = captures.select(
        F.col("record_id").alias("capture"), F.explode("concurrent_to").alias("record_id")
    ).join(sides.drop("concurrent_to"), "record_id").select("capture", *sides.columns[:-1])
    inner = F.struct("record_id", "head", "warc_date")
    both = named.unionByName(naming).groupBy("capture").agg(*[
        x for kind in ("request", "metadata") for x in (
            F.min(F.when(F.col("record_type") == kind, inner)).alias(kind),
            F.count_distinct(F.when(F.col("record_type") == kind, F.col("record_id"))).alias(f"{kind}s"),
        )
    ])
    return captures.join(both, captures["record_id"] == both["capture"], "left").select(
        "record_id", "record_type", "target_uri", captures["warc_date"], "refers_to",
        captures["head"], "payload_bytes", "payload_digest", "payload",
        "request", F.coalesce("requests", F.lit(0)).alias("requests"),
        "metadata", F.coalesce("metadatas", F.lit(0)).alias("metadatas"),
        F.regexp_extract("metadata.head", r"(?:^|\n)page-id: (-?\d+)", 1).try_cast("long").alias("page_id"),
    )


def op5_warc(spark: SparkSession, pages: DataFrame) -> DataFrame:
    """Write all pages to archives, read them, assemble them, digest each capture."""
    folder = fresh_dir(spark, "warc")
    written = write_archives(with_revisits(pages), folder)
    files = [x.file for x in written.select("file").orderBy("file").collect()]
    records = stored(read_archives(spark, folder, files, payload=False), "records")
    captures = stored(assemble(records).drop("payload"), "captures")
    ids = captures.filter("record_type = 'response'").groupBy(F.col("record_id").alias("first")).agg(
        F.min("page_id").alias("first_page")
    )
    return captures.join(ids, captures["refers_to"] == ids["first"], "left").select(
        "page_id", "payload_bytes", "payload_digest", "record_type",
        F.col("first_page").alias("refers_to"),
    )


# Everything follows from the payloads alone.
OP5_SQL = """
WITH p AS (
  SELECT page_id, coalesce(html, '') AS html, strlen(coalesce(html, '')) AS payload_bytes,
         sha256(coalesce(html, '')) AS payload_digest FROM pages
), f AS (
  SELECT *, min(page_id) OVER (PARTITION BY payload_digest) AS first FROM p
)
SELECT page_id, payload_bytes, payload_digest,
  CASE WHEN payload_bytes >= 100 AND first < page_id THEN 'revisit' ELSE 'response' END AS record_type,
  CASE WHEN payload_bytes >= 100 AND first < page_id THEN first END AS refers_to
FROM f
"""
