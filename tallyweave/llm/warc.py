"""WARC archives: writing captures, reading records back, and assembling transactions.

A capture is written as three records: the response (or a revisit that points at the response with
the same payload), the request, and a metadata record; the last two name the first in
WARC-Concurrent-To. Records are the lines of Spark's text writer, with CRLF CRLF as the line
end, so archives can be written to and read from any file system that Spark knows. Each file is one gzip stream;
``max_file_bytes`` bounds its uncompressed size on average, since a reader takes a whole compressed file in memory
(records are unpacked one at a time).

``assemble`` joins request, metadata and response records whichever side names the other, and
metadata that name only the request, and gives one nested row per response or revisit. Where several requests
or metadata records belong to one capture, the one with the smallest record id is nested, ``n_requests`` and
``n_metadata`` tell how many there are, and ``members`` lists them all, so no capture grows without bound.

NULL html is an empty payload, a NULL URL gives no target header, and NULL page ids sort after all
others. A page that occurs twice is two captures. A record that is stored twice counts once. Records
that belong to no capture appear in ``unassembled``. No rows give no rows; further columns are ignored.
"""

from __future__ import annotations

import base64
import hashlib
import zlib
from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from tallyweave.llm.common import text_or_empty
from tallyweave.operators.hot_keys import heavy_keys, hot_keys, lookup
from tallyweave.sources.staging import new_path, stage

CRLF = "\r\n"
MAX_FILE_BYTES, BATCH_BYTES = 64 << 20, 1 << 20
BASE32 = "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567"
ANCHORS, MEMBERS = ("response", "revisit"), ("request", "metadata")

RECORD = T.StructType([
    T.StructField("record_id", T.StringType()), T.StructField("record_type", T.StringType()),
    T.StructField("target_uri", T.StringType()), T.StructField("date", T.StringType()),
    T.StructField("concurrent_to", T.ArrayType(T.StringType())), T.StructField("refers_to", T.StringType()),
    T.StructField("declared_digest", T.StringType()), T.StructField("content_type", T.StringType()),
    T.StructField("head", T.StringType()), T.StructField("payload", T.BinaryType()),
    T.StructField("payload_bytes", T.LongType()), T.StructField("payload_digest", T.StringType()),
])
_ARROW = pa.schema([("record_id", pa.string()), ("record_type", pa.string()), ("target_uri", pa.string()), ("date", pa.string()),
                    ("concurrent_to", pa.list_(pa.string())), ("refers_to", pa.string()), ("declared_digest", pa.string()),
                    ("content_type", pa.string()), ("head", pa.string()), ("payload", pa.binary()),
                    ("payload_bytes", pa.int64()), ("payload_digest", pa.string())])


def base32_of_hex(digest: Column, digits: int = 40) -> Column:
    """Base32 of a hexadecimal string whose length is a multiple of five."""
    characters = []
    for at in range(1, digits, 5):
        value = F.conv(F.substring(digest, at, 5), 16, 10).cast("int")
        characters += [F.substr(F.lit(BASE32), F.shiftright(value, shift).bitwiseAND(31) + 1, F.lit(1)) for shift in (15, 10, 5, 0)]
    return F.concat(*characters)


def _record_id(kind: str, page: Column, url: Column, sha1: Column, copy: Column) -> Column:
    """An id that follows from the record's content alone, so that any run or retry gives the same one."""
    h = F.md5(F.concat_ws("|", F.lit(kind), F.coalesce(page.cast("string"), F.lit("none")), F.coalesce(url, F.lit("\0none")), sha1, copy.cast("string")))
    return F.concat(F.lit("<urn:uuid:"), F.concat_ws("-", *[F.substring(h, at, n) for at, n in ((1, 8), (9, 4), (13, 4), (17, 4), (21, 12))]), F.lit(">"))


def _escaped(url: Column) -> Column:
    """A URL without the characters that would end a header line."""
    for found, put in (("\r", "%0D"), ("\n", "%0A"), ("\t", "%09"), (" ", "%20")):
        url = F.replace(url, F.lit(found), F.lit(put))
    return url


def _record(kind: Column | str, record_id: Column, fields: list[tuple[str, Column]], block: Column) -> Column:
    lines = [F.lit("WARC/1.1"), F.concat(F.lit("WARC-Type: "), F.lit(kind) if isinstance(kind, str) else kind),
             F.concat(F.lit("WARC-Record-ID: "), record_id)]
    lines += [F.concat(F.lit(f"{name}: "), value) for name, value in fields]  # concat_ws leaves out NULL lines
    lines.append(F.concat(F.lit("Content-Length: "), F.octet_length(block).cast("string")))
    return F.concat(F.concat_ws(CRLF, *lines), F.lit(CRLF + CRLF), block)


def with_revisits(pages: DataFrame, min_bytes: int = 0) -> DataFrame:
    """Pages with their payload, its digest and, where a page with an equal payload and a smaller id exists,
    that page (``_first``). Payloads under ``min_bytes`` are never revisits."""
    base = pages.select(F.col("page_id").cast("long").alias("_page"), F.col("url").alias("_url"), text_or_empty("html").alias("_payload")).withColumn(
        "_sha1", F.sha1(F.col("_payload").cast("binary")))
    keys = stage(base.groupBy("_page", "_url", "_sha1", F.octet_length("_payload").alias("_bytes")).agg(F.count("*").alias("_copies")), "warc-keys")
    order = F.struct(F.col("_page").isNull().alias("a"), F.col("_page").alias("page"), F.col("_url").isNull().alias("b"), F.col("_url").alias("url"))
    groups = (keys.filter(F.col("_bytes") >= min_bytes).groupBy("_sha1")
              .agg(F.min(order).alias("_first"), F.sum("_copies").alias("_n")).filter("_n > 1"))
    joined = lookup(base, groups.select("_sha1", "_first"), ["_sha1"], ["_page", "_url"], hot=heavy_keys(groups, ["_sha1"], "_n"))
    copy = F.lit(1)
    if not keys.filter("_copies > 1").isEmpty():  # rows that agree in everything are told apart by a number
        copy = F.row_number().over(Window.partitionBy("_sha1", "_page", "_url").orderBy(F.lit(1)))
    is_first = F.col("_page").eqNullSafe(F.col("_first.page")) & F.col("_url").eqNullSafe(F.col("_first.url")) & (F.col("_copy") == 1)
    return joined.withColumn("_copy", copy).withColumn("_first", F.when(~is_first, F.col("_first")))


def write_archives(pages: DataFrame, path: str, date: str = "2024-01-01T00:00:00Z", min_bytes: int = 0,
                   max_file_bytes: int = MAX_FILE_BYTES) -> None:
    rows, size = pages.agg(F.count("*"), F.sum(F.octet_length(F.col("html")) + 2048)).first()
    per_file = max(3, 3 * int((rows or 1) * max_file_bytes / max(size or 1, 1)))
    page = with_revisits(pages, min_bytes)
    digest = F.concat(F.lit("sha1:"), base32_of_hex(F.col("_sha1")))
    uri = _escaped(F.col("_url"))
    revisit = F.col("_first").isNotNull()

    def own_id(kind: str) -> Column:
        return _record_id(kind, F.col("_page"), F.col("_url"), F.col("_sha1"), F.col("_copy"))

    original = _record_id("response", F.col("_first.page"), F.col("_first.url"), F.col("_sha1"), F.lit(1))
    page = page.withColumns({"_original_id": F.when(revisit, original), "_response_id": own_id("response")})
    http = F.concat(F.lit(f"HTTP/1.1 200 OK{CRLF}Content-Type: text/html; charset=utf-8{CRLF}Content-Length: "),
                    F.octet_length("_payload").cast("string"), F.lit(CRLF + CRLF))
    ask = F.concat(F.lit("GET "), F.coalesce(uri, F.lit("/")), F.lit(f" HTTP/1.1{CRLF}{CRLF}"))
    about = F.concat(F.lit("page-id: "), F.coalesce(F.col("_page").cast("string"), F.lit("")), F.lit(CRLF))
    common = [("WARC-Date", F.lit(date)), ("WARC-Target-URI", uri)]
    to_response = ("WARC-Concurrent-To", F.col("_response_id"))
    records = F.array(
        _record(F.when(revisit, "revisit").otherwise("response"), F.col("_response_id"), [
            *common, ("WARC-Payload-Digest", digest),
            ("WARC-Profile", F.when(revisit, "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest")),
            ("WARC-Refers-To", F.col("_original_id")), ("Content-Type", F.lit("application/http;msgtype=response")),
        ], F.when(revisit, http).otherwise(F.concat(http, F.col("_payload")))),
        _record("request", own_id("request"), [*common, to_response, ("Content-Type", F.lit("application/http;msgtype=request"))], ask),
        _record("metadata", own_id("metadata"), [*common, to_response, ("Content-Type", F.lit("application/warc-fields"))], about))
    (page.select(F.explode(records).alias("value")).write.option("lineSep", CRLF + CRLF).option("compression", "gzip")
     .option("maxRecordsPerFile", per_file).text(path))


def _unpacked(content: bytes, step: int = 1 << 20) -> Iterator[bytes]:
    """A file's bytes in steps; gzip files may have one member or one per record."""
    view = memoryview(content)
    if bytes(view[:2]) != b"\x1f\x8b":
        for at in range(0, len(view), step):
            yield bytes(view[at:at + step])
        return
    unzip = zlib.decompressobj(31)
    for at in range(0, len(view), step):
        piece = bytes(view[at:at + step])
        while piece:
            yield unzip.decompress(piece, step)
            piece = unzip.unconsumed_tail or unzip.unused_data
            if unzip.eof:
                unzip = zlib.decompressobj(31)
    yield unzip.flush()


def parsed_records(content: bytes) -> Iterator[tuple]:
    """The records of one archive, each cut out by its Content-Length."""
    buffer, steps = bytearray(), _unpacked(content)

    def fill(n: int) -> bool:
        while len(buffer) < n:
            more = next(steps, None)
            if more is None:
                return False
            buffer.extend(more)
        return True

    while True:
        while fill(2) and buffer[:2] == b"\r\n":
            del buffer[:2]
        if not fill(1):
            return
        end = -1
        while (end := buffer.find(b"\r\n\r\n")) < 0:
            if not fill(len(buffer) + 1):
                raise ValueError("a WARC record without end of header")
        version, *lines = bytes(buffer[:end]).decode("utf-8", "replace").split("\r\n")
        if not version.startswith("WARC/"):
            raise ValueError(f"not a WARC record: {version[:40]!r}")
        fields: dict[str, list[str]] = {}
        for line in lines:
            name, _, value = line.partition(":")
            fields.setdefault(name.strip().lower(), []).append(value.strip())
        size = int(fields.get("content-length", ["0"])[0])
        if not fill(end + 4 + size):
            raise ValueError("a WARC record is cut off")
        block = bytes(buffer[end + 4:end + 4 + size])
        del buffer[:end + 4 + size]

        def one(name: str) -> str | None:
            return fields.get(name, [None])[0]

        kind = one("content-type") or ""
        head, payload = b"", block
        if kind.startswith("application/http"):
            head, _, payload = block.partition(b"\r\n\r\n")
        yield (one("warc-record-id"), one("warc-type"), one("warc-target-uri"), one("warc-date"), fields.get("warc-concurrent-to", []),
               one("warc-refers-to"), one("warc-payload-digest"), kind, head.decode("utf-8", "replace"), payload, len(payload),
               base64.b32encode(hashlib.sha1(payload).digest()).decode())


def read_archives(spark: SparkSession, path: str) -> DataFrame:
    """The records of all archives under ``path``; digest and size are those of the payload as read."""

    def parse(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for files in batches:
            for content in files.column(0):
                rows, size = [], 0
                for row in parsed_records(content.as_py()):
                    rows.append(row)
                    size += len(row[9]) + 500
                    if size > BATCH_BYTES:
                        batch = pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows), _ARROW)], schema=_ARROW)
                        rows, size = [], 0
                        yield batch
                if rows:
                    yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows), _ARROW)], schema=_ARROW)

    return spark.read.format("binaryFile").load(path).select("content").mapInArrow(parse, RECORD)


def members(records: DataFrame) -> DataFrame:
    """Which request and metadata records belong to which capture: ``capture_id``, ``member_id``."""
    links = records.select(F.col("record_id").alias("source"), F.col("record_type").alias("kind"), F.explode("concurrent_to").alias("target")).distinct()
    anchors = records.filter(F.col("record_type").isin(*ANCHORS)).select(F.col("record_id").alias("anchor")).distinct()
    named = links.filter(F.col("kind").isin(*MEMBERS)).join(anchors, F.col("target") == F.col("anchor")).select(
        F.col("anchor").alias("capture_id"), F.col("source").alias("member_id"))
    naming = links.filter(F.col("kind").isin(*ANCHORS)).select(F.col("source").alias("capture_id"), F.col("target").alias("member_id"))
    direct = named.union(naming).distinct()
    through = links.filter("kind = 'metadata'").join(direct, F.col("target") == F.col("member_id")).select("capture_id", F.col("source").alias("member_id"))
    return direct.union(through).distinct()


def assemble(records: DataFrame) -> DataFrame:
    """One nested row per response or revisit record. Records of a kind (captures or members) with one id are one record."""
    anchors = records.filter(F.col("record_type").isin(*ANCHORS)).dropDuplicates(["record_id"])
    own = records.filter(F.col("record_type").isin(*MEMBERS)).dropDuplicates(["record_id"])
    nested = F.struct("record_id", "record_type", "target_uri", "date", "content_type", "head", "payload", "payload_bytes", "payload_digest")
    owned = (own.join(members(records), F.col("record_id") == F.col("member_id"))
             .groupBy("capture_id").agg(*[
                 column for kind, plural in (("request", "n_requests"), ("metadata", "n_metadata"))
                 for column in (F.min_by(F.when(F.col("record_type") == kind, nested), F.when(F.col("record_type") == kind, F.col("record_id"))).alias(kind),
                                F.count_if(F.col("record_type") == kind).alias(plural))]))
    return anchors.join(owned, F.col("record_id") == F.col("capture_id"), "left").select(
        F.col("record_id").alias("capture_id"), F.col("record_type"), "refers_to", "declared_digest",
        nested.alias("response"), "request", "metadata",
        F.coalesce("n_requests", F.lit(0)).alias("n_requests"), F.coalesce("n_metadata", F.lit(0)).alias("n_metadata"))


def unassembled(records: DataFrame) -> DataFrame:
    """Request and metadata records that belong to no capture."""
    owned = members(records).select("member_id")
    return records.filter(F.col("record_type").isin(*MEMBERS)).join(owned, F.col("record_id") == F.col("member_id"), "left_anti")


def page_captures(pages: DataFrame, min_bytes: int = 0, payloads: bool = True) -> DataFrame:
    """Write the pages to archives, read them back, and give one assembled row per page, with revisits
    resolved to the response that they refer to. The archives are parsed once; without ``payloads`` the bodies of
    responses stay in them, and only their size and digest are carried."""
    path = new_path(pages.sparkSession, "warc")
    write_archives(pages, path, min_bytes=min_bytes)
    records = read_archives(pages.sparkSession, path)
    if not payloads:
        records = records.withColumn("payload", F.when(F.col("record_type").isin(*MEMBERS), F.col("payload")))
    records = stage(records, "warc-records", "zstd")
    captures = assemble(records).withColumn(
        "page_id", F.regexp_extract(F.col("metadata.payload").cast("string"), r"page-id: (-?\d+)", 1).try_cast("long"))
    originals = captures.filter("record_type = 'response'").select(
        F.col("capture_id").alias("refers_to"), F.col("page_id").alias("original_page"),
        F.col("response.payload_bytes").alias("original_bytes"), F.col("response.payload_digest").alias("original_digest"))
    return lookup(captures, originals, ["refers_to"], ["capture_id"], hot=hot_keys(records.select("refers_to"), ["refers_to"]))
