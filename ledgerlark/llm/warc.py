"""WARC archives: one gzip member per record, written and read back sequentially.

Writers put each partition's records into archives of bounded size below a shared folder.
An archive is complete once its row stands in the manifest table, which Spark commits as a
whole; files of attempts that failed are in no manifest and are never read. The reader
takes an archive as a stream: chunks go through one incremental decompressor per member,
headers are parsed when complete, the body is framed by its Content-Length, and both
digests are computed as the bytes pass.
"""

from __future__ import annotations

import base64
import hashlib
import re
import uuid
import zlib
from collections.abc import Iterator
from urllib.parse import quote, unquote

import pyarrow as pa
import pyarrow.fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerlark.llm.common import written
from ledgerlark.session import scratch_path

CHUNK = 1 << 16
MAX_HEADER = 1 << 31  # a header holds its url, and no text of a table is longer
ARCHIVE_BYTES = 64 << 20
MOST_READERS = 20_000  # tasks of a reading job; with more archives a task reads several
LEAST_REVISIT = 1000
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"

MANIFEST = "path string, records bigint, bytes bigint"
RECORD = (
    "page_id bigint, url string, record_type string, refers_to bigint, payload_bytes bigint, payload_digest string, "
    "verified boolean"
)


#: Hadoop's names of a store, and those that pyarrow has for it.
SCHEMES = {"s3a": "s3", "s3n": "s3", "gcs": "gs"}


def arrow_uri(uri: str) -> str:
    """The URI of a shared folder as pyarrow spells it; a plain path is a local file. HDFS needs libhdfs on the executors."""
    scheme, colon, rest = uri.partition(":")
    if not colon or not re.fullmatch(r"[a-z][a-z0-9+.-]+", scheme):
        return f"file://{uri}"
    if scheme == "file":  # Hadoop writes one slash where there is no host
        return f"file:///{rest.lstrip('/')}"
    return f"{SCHEMES.get(scheme, scheme)}:{rest}"


def storage(uri: str) -> tuple[pyarrow.fs.FileSystem, str]:
    """The file system and path of a shared folder's URI."""
    return pyarrow.fs.FileSystem.from_uri(arrow_uri(uri))


def _b32(data: bytes) -> str:
    return "sha1:" + base64.b32encode(data).decode()


def record_id(page_id: int | None) -> str:
    return f"<urn:page:{'' if page_id is None else page_id}>"


def page_of(urn: str | None) -> int | None:
    found = re.fullmatch(r"<urn:page:(-?\d+)>", urn or "")
    return int(found[1]) if found else None


def record(
    page_id: int | None, url: str | None, payload: bytes, refers_to: int | None, revisit: bool, date: str
) -> bytes:
    """One record as a gzip member. A revisit keeps the HTTP header, and so the full length, without the payload."""
    http = (
        "HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n" f"Content-Length: {len(payload)}\r\n\r\n"
    ).encode()
    block = http if revisit else http + payload
    fields = [
        ("WARC-Type", "revisit" if revisit else "response"),
        ("WARC-Record-ID", record_id(page_id)),
        ("WARC-Date", date),
        ("Content-Type", "application/http; msgtype=response"),
        ("WARC-Payload-Digest", _b32(hashlib.sha1(payload).digest())),
        ("WARC-Block-Digest", _b32(hashlib.sha1(block).digest())),
    ]
    if url is not None:  # control characters would break the header
        fields.append(("WARC-Target-URI", re.sub(r"[\x00-\x20\x7f-\xa0%]", lambda m: quote(m[0]), url)))
    if revisit:
        fields += [("WARC-Refers-To", record_id(refers_to)), ("WARC-Profile", PROFILE)]
    fields.append(("Content-Length", str(len(block))))
    head = "WARC/1.1\r\n" + "".join(f"{k}: {v}\r\n" for k, v in fields) + "\r\n"
    packer = zlib.compressobj(6, zlib.DEFLATED, 31)
    return packer.compress(head.encode() + block + b"\r\n\r\n") + packer.flush()


class Damaged(ValueError):
    """An archive that is cut short or wrongly framed."""


def members(chunks: Iterator[bytes]) -> Iterator[Iterator[bytes]]:
    """The gzip members of a stream, each as an iterator of its decompressed pieces."""
    rest = b""
    chunks = iter(chunks)

    def more() -> bytes:
        return next(chunks, b"")

    while rest := rest or more():
        unpack = zlib.decompressobj(31)
        done = False

        def pieces(unpack=unpack):
            nonlocal rest, done
            data = rest
            while True:
                try:
                    piece = unpack.decompress(data, CHUNK)
                except zlib.error as error:
                    raise Damaged(str(error)) from None
                if piece:
                    yield piece
                if unpack.eof:
                    rest, done = unpack.unused_data, True
                    return
                data = unpack.unconsumed_tail or (b"" if piece else more())
                if not data and not piece:
                    raise Damaged("a gzip member is cut short")

        inner = pieces()
        yield inner
        for _ in inner:  # what the caller has left unread
            pass
        if not done:
            raise Damaged("a gzip member is cut short")


def header_fields(head: bytes) -> dict[str, str]:
    lines = head.decode("utf-8", "replace").split("\r\n")
    return {k.strip().lower(): v.strip() for k, _, v in (line.partition(":") for line in lines[1:]) if k}


def until_blank_line(buffer: bytearray, pieces: Iterator[bytes]) -> bytes:
    """Takes a header off the buffer, reading on as needed."""
    searched = 0
    while (end := buffer.find(b"\r\n\r\n", searched)) < 0:
        if len(buffer) > MAX_HEADER:
            raise Damaged("a header has no end")
        searched = max(0, len(buffer) - 3)
        piece = next(pieces, None)
        if piece is None:
            raise Damaged("a header has no end")
        buffer += piece
    head = bytes(buffer[:end])
    del buffer[: end + 4]
    return head


def read_record(pieces: Iterator[bytes], with_payload: bool) -> dict:
    """One record of a member, its bytes hashed as they pass; only ``with_payload`` keeps them."""
    buffer = bytearray()
    head = until_blank_line(buffer, pieces)
    if not head.startswith(b"WARC/1."):
        raise Damaged("no WARC record")
    fields = header_fields(head)
    left = int(fields["content-length"])
    block, payload, kept = hashlib.sha1(), hashlib.sha1(), []
    http, inside, length = bytearray(), False, 0
    while left or buffer:
        piece = bytes(buffer) if buffer else next(pieces, None)
        buffer.clear()
        if piece is None:
            raise Damaged("a record is cut short")
        body, tail = piece[:left], piece[left:]
        left -= len(body)
        block.update(body)
        if not inside:
            http += body
            if (end := http.find(b"\r\n\r\n")) >= 0:
                body, inside = bytes(http[end + 4 :]), True
                del http[end:]
            elif len(http) > MAX_HEADER:
                raise Damaged("a header has no end")
        if inside and body:
            payload.update(body)
            length += len(body)
            if with_payload:
                kept.append(body)
        if not left:
            end_mark = tail + b"".join(pieces)
            if end_mark != b"\r\n\r\n":
                raise Damaged("a record does not end where its length says")
            break
    told = base64.b32decode(fields["warc-payload-digest"].removeprefix("sha1:"))
    kind = fields["warc-type"]
    verified = fields["warc-block-digest"] == _b32(block.digest()) and (kind == "revisit" or told == payload.digest())
    full = header_fields(b"HTTP\r\n" + bytes(http).partition(b"\r\n")[2]).get("content-length")
    out = {
        "page_id": page_of(fields["warc-record-id"]),
        "url": unquote(fields["warc-target-uri"]) if "warc-target-uri" in fields else None,
        "record_type": kind,
        "refers_to": page_of(fields.get("warc-refers-to")),
        "payload_bytes": int(full) if kind == "revisit" else length,
        "payload_digest": told.hex(),
        "verified": verified and (kind == "revisit" or int(full) == length),
    }
    return out | ({"payload": b"".join(kept)} if with_payload else {})


def first_holders(pages: DataFrame, key: str, payload: str, least: int) -> DataFrame:
    """``__sha``, ``__holder``: of payloads that occur more than once, the largest key."""
    data = F.coalesce(F.col(payload), F.lit("")).cast("binary")
    seen = pages.select(F.col(key).alias("__key"), F.sha2(data, 256).alias("__sha"), F.octet_length(data).alias("__n"))
    counts = seen.where(F.col("__n") >= least).groupBy("__sha").agg(F.count(F.lit(1)).alias("__c"), F.max("__key").alias("__holder"))
    return counts.where("__c > 1").select("__sha", "__holder")


def write_archives(
    pages: DataFrame,
    folder: str,
    key: str = "page_id",
    url: str = "url",
    payload: str = "html",
    date: str = "2024-01-01T00:00:00Z",
    archive_bytes: int = ARCHIVE_BYTES,
    least_revisit: int = LEAST_REVISIT,
) -> DataFrame:
    """Write a record per row below ``folder`` and return the manifest of archives.

    NULL payloads are empty, a NULL url is left out, a NULL key gives a record without a
    page number. Of equal payloads of at least ``least_revisit`` bytes the rows with the
    largest key are responses (repeated rows of that key all are) and the others revisit
    it. Only digests and keys are shuffled to find them; the payloads stay where they are
    unless the list of repeated payloads is too large to be sent along.
    """
    spark = pages.sparkSession
    holders = written(first_holders(pages, key, payload, least_revisit), "warc-holders")
    data = F.coalesce(F.col(payload), F.lit("")).cast("binary")
    rows = pages.select(F.col(key).cast("bigint").alias("page_id"), F.col(url).alias("url"), data.alias("payload"))
    rows = rows.withColumn("__sha", F.sha2("payload", 256)).join(holders, "__sha", "left")
    rows = rows.select(
        "page_id",
        "url",
        "payload",
        F.col("__holder").alias("refers_to"),
        F.coalesce(~F.col("page_id").eqNullSafe(F.col("__holder")) & F.col("__holder").isNotNull(), F.lit(False)).alias("revisit"),
    )

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, base = storage(folder)
        store.create_dir(base, recursive=True)
        done, out, records, size, path = [], None, 0, 0, ""

        def close():
            if out is not None:
                out.close()
                done.append((path, records, size))

        for batch in batches:
            for row in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if out is None or size >= archive_bytes:
                    close()
                    path, records, size = f"{base}/{uuid.uuid4().hex}.warc.gz", 0, 0
                    out = store.open_output_stream(path, compression=None)
                member = record(*row, date)
                out.write(member)
                records, size = records + 1, size + len(member)
        close()
        names = ["path", "records", "bytes"]
        yield pa.RecordBatch.from_pydict(
            {n: pa.array([d[i] for d in done], pa.string() if i == 0 else pa.int64()) for i, n in enumerate(names)}
        )

    return written(rows.mapInArrow(write, MANIFEST), "warc-manifest")


def read_archives(manifest: DataFrame, folder: str, with_payload: bool = False) -> DataFrame:
    """A row per record of the archives in ``manifest``; a damaged archive stops the job with its path.

    ``verified`` says whether the digests and the lengths of a record agree with its bytes.
    """

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, _ = storage(folder)
        names = [x.split()[0] for x in kinds.split(", ")]
        for batch in batches:
            for path, expected in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                rows, count, weight = [], 0, 0
                with store.open_input_stream(path, compression=None) as stream:
                    for pieces in members(iter(lambda s=stream: s.read(CHUNK), b"")):
                        try:
                            rows.append(read_record(pieces, with_payload))
                        except (Damaged, KeyError) as error:
                            raise Damaged(f"{path}, record {count}: {error}") from error
                        count += 1
                        weight += 200 + len(rows[-1].get("payload", b""))
                        if weight > 8 << 20:
                            yield pa.RecordBatch.from_pylist(rows, schema)
                            rows, weight = [], 0
                if count != expected:
                    raise Damaged(f"{path}: {count} records of {expected}")
                if rows:
                    yield pa.RecordBatch.from_pylist(rows, schema)
        yield pa.RecordBatch.from_pylist([], schema)

    kinds = RECORD + (", payload binary" if with_payload else "")
    arrow = {"bigint": pa.int64(), "string": pa.string(), "boolean": pa.bool_(), "binary": pa.binary()}
    schema = pa.schema([(n, arrow[k]) for n, k in (x.split() for x in kinds.split(", "))])
    # An archive is one sequential stream, so archives are what tasks can share out.
    tasks = max(1, min(manifest.count(), MOST_READERS))
    return manifest.select("path", "records").repartition(tasks).mapInArrow(read, kinds)


def archive_folder(spark: SparkSession) -> str:
    return scratch_path(spark, "warc")
