"""WARC archives and revisit resolution.

Archives are folders of files, each a sequence of gzip members with one record
each, written by Spark's own text writer (so failed or repeated tasks leave no
trace): a row is a member without its last byte, and the line separator is that
byte. The last byte of a member is the high byte of its length, zero below
16 MB; a longer record is followed by an empty member, which ends in zero too.

Deduplication reads the headers, shuffles them (never bodies) by payload digest,
elects the response of each digest with pre-aggregated maxima, joins the others
to it, and writes new archives: responses whole, revisits with the HTTP header
alone, all with fresh record ids and dates. The revisits are broadcast to the
bodies while there are FEW_REVISITS at most; beyond that bodies move once,
compressed, by their place in the archive, which no key can make uneven.

Defined results: a null payload is empty, a null id or URL has no header field
and reads back as null, a null id is elected only among null ids, of records
with one id and payload the last in the archive is elected, control characters
in URLs are percent-encoded, repeated rows give a record each, other columns are
not read, an empty table gives archives without records.
"""

from __future__ import annotations

import base64
import hashlib
import re
import uuid
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from glotta.llm.common import map_batches, materialize, new_path, table

DATE = "2024-01-01T00:00:00Z"
MIN_PAYLOAD = 0
PER_FILE = 5000
FEW_REVISITS = 200_000  # some 40 MB to broadcast; beyond that bodies and revisits meet by a shuffle
ID_FIELD = "X-Source-Id"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
HEADER = ("path string, number long, record_id string, record_type string, source_id long, target_uri string, "
          "date string, payload_digest string, payload_bytes long, refers_to_id string, refers_to_uri string")
_NAMES = [c.split()[0] for c in HEADER.split(", ")]
_NAMESPACE = uuid.UUID("6ba7b811-9dad-11d1-80b4-00c04fd430c8")  # fixed value: the name space for URLs


def digest(payload: bytes) -> str:
    """The bare base32 SHA-1."""
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def new_record_id(*parts: object) -> str:
    return f"<urn:uuid:{uuid.uuid5(_NAMESPACE, ' '.join(map(str, parts)))}>"


def _safe(url: str) -> str:
    return re.sub(r"[\x00-\x20\x7f]", lambda m: f"%{ord(m.group()):02X}", url)


def record(fields: list[tuple[str, str | None]], block: bytes) -> bytes:
    """One record as a gzip member that ends in a zero byte."""
    head = "".join(f"{k}: {v}\r\n" for k, v in fields if v is not None)
    data = f"WARC/1.1\r\n{head}Content-Length: {len(block)}\r\n\r\n".encode() + block + b"\r\n\r\n"
    packer = zlib.compressobj(6, zlib.DEFLATED, 31)
    member = packer.compress(data) + packer.flush()
    if member[-1]:
        packer = zlib.compressobj(6, zlib.DEFLATED, 31)
        member += packer.flush()
    return member


def _http(payload_bytes: int) -> bytes:
    return f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {payload_bytes}\r\n\r\n".encode()


def response(record_id: str, source_id: int | None, url: str | None, date: str, http: bytes, payload: bytes,
             payload_digest: str) -> bytes:
    return record([("WARC-Type", "response"), ("WARC-Record-ID", record_id), ("WARC-Date", date),
                   ("WARC-Target-URI", url and _safe(url)), (ID_FIELD, None if source_id is None else str(source_id)),
                   ("WARC-Payload-Digest", f"sha1:{payload_digest}"),
                   ("Content-Type", "application/http; msgtype=response")], http + payload)


def revisit(record_id: str, source_id: int | None, url: str | None, date: str, http: bytes, payload_digest: str,
            refers_to: str, refers_to_uri: str | None) -> bytes:
    return record([("WARC-Type", "revisit"), ("WARC-Record-ID", record_id), ("WARC-Date", date),
                   ("WARC-Target-URI", url and _safe(url)), (ID_FIELD, None if source_id is None else str(source_id)),
                   ("WARC-Payload-Digest", f"sha1:{payload_digest}"), ("WARC-Profile", PROFILE),
                   ("WARC-Refers-To", refers_to), ("WARC-Refers-To-Target-URI", refers_to_uri),
                   ("WARC-Refers-To-Date", date), ("Content-Type", "application/http; msgtype=response")], http)


def members(content: bytes, step: int = 1 << 14) -> Iterator[tuple[bytes, bytes]]:
    """``(member, its data)`` of each gzip member that is not empty."""
    view, at = memoryview(content), 0
    while at < len(content):
        unpacker, end, parts = zlib.decompressobj(31), at, []
        while not unpacker.eof:
            if end >= len(content):
                raise ValueError("an archive ends within a record")
            parts.append(unpacker.decompress(view[end:end + step]))
            end += step
        end = min(end, len(content)) - len(unpacker.unused_data)
        if data := b"".join(parts):
            yield bytes(view[at:end]), data
        at = end


def parse(data: bytes) -> tuple[dict[str, str], bytes]:
    """Header fields (names in lower case) and block."""
    head, _, rest = data.partition(b"\r\n\r\n")
    lines = head.decode("utf-8", "replace").split("\r\n")
    fields = {k.strip().lower(): v.strip() for k, _, v in (line.partition(":") for line in lines[1:])}
    return fields, rest[: int(fields["content-length"])]


def _write(rows: DataFrame, path: str) -> None:
    """``rows`` has one binary column of members."""
    rows.select(F.col("member").cast("string")).write.option("lineSep", "\0").option(
        "maxRecordsPerFile", PER_FILE).text(path)


def write_archives(pages: DataFrame, path: str, id_col: str = "page_id", url_col: str = "url",
                   payload_col: str = "html", date: str = DATE) -> None:
    """A response record for every row, in UTF-8."""
    chosen = pages.select(F.col(id_col).cast("long").alias("id"), F.col(url_col).cast("string").alias("url"),
                          F.coalesce(F.col(payload_col).cast("binary"), F.lit(b"")).alias("payload"))

    def run(batches):
        part, n = TaskContext.get().partitionId(), 0
        for batch in batches:
            out = []
            for id_, url, payload in zip(*(c.to_pylist() for c in batch.columns)):
                out.append(response(new_record_id("captured", part, n), id_, url, date, _http(len(payload)), payload,
                                    digest(payload))[:-1])
                n += 1
            yield pa.RecordBatch.from_arrays([pa.array(out, pa.binary())], names=["member"])

    _write(chosen.mapInArrow(run, "member binary"), path)


def _header(path: str, number: int, data: bytes) -> tuple:
    fields, block = parse(data)
    http = block.partition(b"\r\n\r\n")[0]
    sized = re.search(rb"(?im)^content-length:\s*(\d+)", http)
    source = fields.get(ID_FIELD.lower())
    return (path, number, fields["warc-record-id"], fields["warc-type"], source and int(source),
            fields.get("warc-target-uri"), fields["warc-date"],
            fields["warc-payload-digest"].removeprefix("sha1:"), int(sized.group(1)), fields.get("warc-refers-to"),
            fields.get("warc-refers-to-target-uri"))


_TYPES = [pa.string(), pa.int64(), pa.string(), pa.string(), pa.int64(), *[pa.string()] * 3, pa.int64(),
          *[pa.string()] * 2]


def _files(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.format("binaryFile").load(path).select("path", "content")


def read_headers(spark: SparkSession, path: str) -> DataFrame:
    """One row per record, without bodies; the digest and size are those of the full payload, for revisits too."""

    def run(batch: pa.RecordBatch):
        for path_, content in zip(*(batch.column(i) for i in (0, 1))):
            rows = [_header(path_.as_py(), n, data) for n, (_, data) in enumerate(members(content.as_py()))]
            if rows:
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), _TYPES)], names=_NAMES)

    return map_batches(_files(spark, path), run, HEADER)


def resolve_revisits(headers: DataFrame, min_payload: int = MIN_PAYLOAD) -> DataFrame:
    """``headers`` of response records with the response that each revisits: ``response_*``, null for a response."""
    rank = F.struct(F.col("source_id").isNotNull().alias("named"), "source_id", "path", "number", "record_id",
                    "target_uri")
    same = ["payload_digest", "payload_bytes"]
    elected = (headers.filter(F.col("payload_bytes") >= min_payload).groupBy(*same)
               .agg(F.max(rank).alias("r"), F.count(F.lit(1)).alias("n")).filter("n > 1").drop("n"))
    joined = headers.join(elected, same, "left")
    other = (F.col("r.path") != F.col("path")) | (F.col("r.number") != F.col("number"))
    return joined.select(*headers.columns, F.when(other, F.col("r.record_id")).alias("response_record"),
                         F.when(other, F.col("r.target_uri")).alias("response_uri"))


def dedup_archives(spark: SparkSession, source: str, target: str, min_payload: int = MIN_PAYLOAD,
                   date: str = DATE) -> None:
    """Write the archives at ``source`` anew at ``target``, repeated payloads as revisits."""
    headers = materialize(read_headers(spark, source), "warc-headers")
    found = materialize(resolve_revisits(headers, min_payload).filter("response_record is not null").select(
        F.xxhash64("path").alias("file"), "number", "response_record", "response_uri"), "warc-revisits")
    few = found.count() <= FEW_REVISITS  # then the bodies need not move at all

    def read(batch: pa.RecordBatch):
        for path_, content in zip(*(batch.column(i) for i in (0, 1))):
            size, own = 0, []
            for n, (member, _) in enumerate(members(content.as_py())):
                own.append((path_.as_py(), n, member))
                size += len(member)
                if size > 1 << 23:
                    yield _records(own)
                    size, own = 0, []
            if own:
                yield _records(own)

    def renew(batch: pa.RecordBatch):
        out = []
        for member, to, to_uri in zip(*(batch.column(i).to_pylist() for i in (2, 3, 4))):
            fields, block = parse(next(members(member))[1])
            http, mark, payload = block.partition(b"\r\n\r\n")
            id_ = fields.get(ID_FIELD.lower())
            old, url = fields["warc-record-id"], fields.get("warc-target-uri")
            code = fields["warc-payload-digest"].removeprefix("sha1:")
            if to is None:
                made = response(new_record_id("dedup", old), id_, url, date, http + mark, payload, code)
            else:
                made = revisit(new_record_id("dedup", old), id_, url, date, http + mark, code,
                               new_record_id("dedup", to), to_uri)
            out.append(made[:-1])
        yield pa.RecordBatch.from_arrays([pa.array(out, pa.binary())], names=["member"])

    bodies = map_batches(_files(spark, source), read, "path string, number long, member binary")
    joined = bodies.select(F.xxhash64("path").alias("file"), "number", "member").join(
        F.broadcast(found) if few else found, ["file", "number"], "left")
    _write(map_batches(joined, renew, "member binary"), target)


def _records(rows: list[tuple]) -> pa.RecordBatch:
    types = [pa.string(), pa.int64(), pa.binary()]
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), types)],
                                      names=["path", "number", "member"])


def op1_warc_revisits(spark, sf_dir: str) -> DataFrame:
    """Writes every page, deduplicates the archives and reads them back."""
    captured, deduplicated = new_path(spark, "warc-captured"), new_path(spark, "warc-deduplicated")
    write_archives(table(spark, sf_dir, "pages"), captured)
    dedup_archives(spark, captured, deduplicated)
    headers = materialize(read_headers(spark, deduplicated), "warc-read-back")
    targets = headers.filter("record_type = 'response'").select(
        F.col("record_id").alias("refers_to_id"), F.col("source_id").alias("refers_to"))
    return headers.join(targets, "refers_to_id", "left").select(
        F.col("source_id").alias("page_id"), "payload_bytes", "payload_digest", "record_type", "refers_to",
        "target_uri")
