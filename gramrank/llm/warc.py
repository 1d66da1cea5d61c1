"""Legacy ARC archives converted to WARC.

ARC files hold a version block, then records of one header line, whose fields depend on
the version, and as many bytes as the line declares. The converter reads both versions
and gives every record what WARC asks for: an identifier, a timestamp, a type and a
digest. Pages with equal payloads become one response and revisits of it.

Archives are written with Spark's text sink, whose line separator is the end of a
record, so any store that Spark writes to will do, and read as binary files.
"""

from __future__ import annotations

import base64
import hashlib
import re
import uuid
import zlib
from collections import Counter
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from gramrank.session import new_shared_path

#: Payload bytes of an archive, on the average.
ARCHIVE_BYTES = 16 << 20
#: Records of a converted archive at most.
ARCHIVE_RECORDS = 4096
#: Bytes of records a task hands over at a time.
HANDED_BYTES = 4 << 20
RECORD_END = "\r\n\r\n"
#: The fields of a header line by version.
ARC_FIELDS = {
    "1": ("url", "ip", "date", "type", "length"),
    "2": (
        "url",
        "ip",
        "date",
        "type",
        "status",
        "checksum",
        "location",
        "offset",
        "file",
        "length",
    ),
}
IDENTICAL = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"

PARSED = (
    "page_id {id}, uri string, ip string, date string, http_head binary, payload binary,"
    " payload_digest string, record_id string"
)
READ = "page_id {id}, payload_bytes long, payload_digest string, record_type string, refers_to {id}"


# Writing ARC


def _one_field(column: Column) -> Column:
    """A header field: no white space, ``-`` where there is nothing."""
    escaped = column.cast("string")
    for char, code in ((" ", "%20"), ("\r", "%0D"), ("\n", "%0A"), ("\t", "%09")):
        escaped = F.replace(escaped, F.lit(char), F.lit(code))
    return F.when(F.length(escaped) > 0, escaped).otherwise("-")


def write_arc(
    pages: DataFrame, path: str, date: str = "20240101000000", archive_bytes: int = ARCHIVE_BYTES
) -> None:
    """ARC archives of ``pages`` (``page_id, url, html``; null html is empty), the even
    archives in version 1, the odd ones in version 2."""
    spark = pages.sparkSession
    html = F.coalesce(F.col("html"), F.lit(""))
    size = pages.agg(F.sum(F.octet_length(html))).first()[0] or 0
    n = -(-size // archive_bytes) or 1
    head = F.concat(
        F.lit("HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nX-Page-Id: "),
        F.coalesce(F.col("page_id").cast("string"), F.lit("")),
        F.lit("\r\nContent-Length: "),
        F.octet_length(html).cast("string"),
        F.lit("\r\n\r\n"),
    )
    archive = F.pmod(F.xxhash64("page_id", "url", F.crc32(html.cast("binary"))), F.lit(n))
    blocks = pages.select(
        archive.alias("archive"),
        F.lit(1).alias("rank"),
        _one_field(F.col("url")).alias("url"),
        F.concat(head, html).alias("block"),
    )
    length = F.octet_length("block").cast("string")
    second = F.col("archive") % 2 == 1
    version1 = F.concat_ws(" ", "url", F.lit("0.0.0.0"), F.lit(date), F.lit("text/html"), length)
    version2 = F.concat_ws(
        " ",
        "url",
        F.lit("0.0.0.0"),
        F.lit(date),
        F.lit("text/html"),
        F.lit("200"),
        F.lit("-"),
        F.lit("-"),
        F.lit("0"),
        F.concat(F.lit("pages-"), F.col("archive").cast("string"), F.lit(".arc")),
        length,
    )
    records = blocks.withColumn(
        "value", F.concat(F.when(second, version2).otherwise(version1), F.lit("\n"), "block")
    )
    written = _version_blocks(spark, n, date).unionByName(
        records.select("archive", "rank", "value")
    )
    (
        written.repartition(n, "archive")
        .sortWithinPartitions("archive", "rank")
        .select("value")
        .write.option("lineSep", "\n")
        .option("compression", "gzip")
        .text(path)
    )


def _version_blocks(spark: SparkSession, n: int, date: str) -> DataFrame:
    """The block that opens each archive."""
    archive = F.col("id").alias("archive")
    name = F.concat(F.lit("filedesc://pages-"), F.col("id").cast("string"), F.lit(".arc"))
    version = F.when(F.col("id") % 2 == 1, "2").otherwise("1")
    body = F.when(
        F.col("id") % 2 == 1,
        "2 0 archive\nURL IP-address Archive-date Content-type Result-code Checksum"
        " Location Offset Filename Archive-length",
    ).otherwise("1 0 archive\nURL IP-address Archive-date Content-type Archive-length")
    middle = F.when(version == "2", F.concat(F.lit("200 - - 0 "), name, F.lit(" "))).otherwise("")
    line = F.concat(
        name,
        F.lit(f" 0.0.0.0 {date} text/plain "),
        middle,
        F.octet_length(body).cast("string"),
        F.lit("\n"),
        body,
    )
    return spark.range(n).select(archive, F.lit(0).alias("rank"), line.alias("value"))


# Reading ARC


@dataclass
class ArcRecord:
    header: dict[str, str]
    block: bytes


def parse_arc(content: bytes) -> Iterator[ArcRecord]:
    """Records of an archive, version blocks left out. A version block holds for what
    follows it, so archives may be strung together."""
    fields, at = ARC_FIELDS["1"], 0
    while at < len(content):
        if content[at : at + 1] in (b"\n", b"\r"):
            at += 1
            continue
        end = content.find(b"\n", at)
        if end < 0:
            raise ValueError(f"ARC header line without end at byte {at}")
        line = content[at:end].decode("utf-8", "replace").rstrip("\r")
        opens = line.startswith("filedesc://")
        if opens:
            fields = ARC_FIELDS[content[end + 1 : end + 2].decode("ascii", "replace")]
        values = line.rsplit(" ", len(fields) - 1)
        if len(values) != len(fields) or not values[-1].isdigit():
            raise ValueError(f"ARC header line at byte {at}: {line[:200]!r}")
        length = int(values[-1])
        block = content[end + 1 : end + 1 + length]
        if len(block) != length:
            raise ValueError(f"ARC record at byte {at} ends before its declared length")
        at = end + 1 + length
        if not opens:
            yield ArcRecord(dict(zip(fields, values, strict=True)), block)


def unpacked(content: bytes) -> bytes:
    """Contents of an archive that may be compressed, in one member or many."""
    parts = []
    while content[:2] == b"\x1f\x8b":
        member = zlib.decompressobj(wbits=31)
        parts.append(member.decompress(content) + member.flush())
        content = member.unused_data
    return b"".join(parts) if parts else content


def digest_of(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode("ascii")


def warc_date(date: str) -> str:
    """``YYYYMMDDhhmmss``, or its beginning, as a WARC timestamp."""
    digits = re.sub(r"\D", "", date)
    digits = (digits + "00000101000000"[len(digits) :])[:14]
    y, m, d, h, n, s = digits[:4], *(digits[i : i + 2] for i in range(4, 14, 2))
    return f"{y}-{m}-{d}T{h}:{n}:{s}Z"


def http_parts(block: bytes) -> tuple[bytes, bytes]:
    """Head and payload of a HTTP message; a block that is none is all payload."""
    if not block.startswith(b"HTTP/"):
        return b"", block
    head, gap, payload = block.partition(b"\r\n\r\n")
    return head + gap, payload


def _header(head: bytes, name: str) -> str | None:
    match = re.search(rb"(?im)^" + re.escape(name.encode()) + rb":[ \t]*([^\r\n]*)", head)
    value = match[1].decode("utf-8", "replace").strip() if match else ""
    return value or None


def _in_batches(
    names: list[str], schema: pa.Schema, rows: Iterator[tuple]
) -> Iterator[pa.RecordBatch]:
    """Rows in batches of bounded size; the last item of a row is its weight."""
    held, weight = [], 0
    for row in rows:
        held.append(row[:-1])
        weight += row[-1]
        if weight >= HANDED_BYTES or len(held) >= 10_000:
            yield _batch(names, schema, held)
            held, weight = [], 0
    if held:
        yield _batch(names, schema, held)


def _batch(names: list[str], schema: pa.Schema, rows: list[tuple]) -> pa.RecordBatch:
    columns = zip(*rows, strict=True)
    arrays = [pa.array(c, schema.field(n).type) for n, c in zip(names, columns, strict=True)]
    return pa.record_batch(arrays, names=names)


def _archives(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.format("binaryFile").load(path).select("content")


def _parsing(rows: Callable[[bytes], Iterator[tuple]], fields: list[tuple[str, pa.DataType]]):
    schema = pa.schema(fields)

    def parse(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for content in batch.column(0):
                yield from _in_batches(schema.names, schema, rows(unpacked(content.as_py())))

    return parse


def read_arc(spark: SparkSession, path: str) -> DataFrame:
    """Records of the archives below ``path`` with what WARC needs of each:
    ``page_id, uri, ip, date, http_head, payload, payload_digest, record_id``."""

    def rows(content: bytes) -> Iterator[tuple]:
        seen: Counter[str] = Counter()  # equal records lie in the same archive
        for record in parse_arc(content):
            head, payload = http_parts(record.block)
            page, date = _header(head, "X-Page-Id"), warc_date(record.header["date"])
            digest = digest_of(payload)
            name = f"{page}|{record.header['url']}|{date}|{digest}"
            seen[name] += 1
            record_id = f"<urn:uuid:{uuid.uuid5(uuid.NAMESPACE_URL, f'{name}|{seen[name]}')}>"
            yield (
                int(page) if page else None,
                record.header["url"],
                record.header["ip"],
                date,
                head,
                payload,
                digest,
                record_id,
                len(record.block) + 400,
            )

    fields = [
        ("page_id", pa.int64()),
        ("uri", pa.string()),
        ("ip", pa.string()),
        ("date", pa.string()),
        ("http_head", pa.binary()),
        ("payload", pa.binary()),
        ("payload_digest", pa.string()),
        ("record_id", pa.string()),
    ]
    return _archives(spark, path).mapInArrow(_parsing(rows, fields), PARSED.format(id="long"))


# Converting


def to_warc(records: DataFrame, min_bytes: int = 0) -> DataFrame:
    """``[value]``: a WARC record for each of ``read_arc``'s.

    Of equal payloads of at least ``min_bytes`` bytes the one with the smallest page id
    (null is the largest, of equal ids the smallest record id) is a response, the others
    are revisits of it; smaller ones are all responses."""
    spark = records.sparkSession
    key = ["payload_digest", "payload_sha256"]
    known = records.withColumns(
        {
            "payload_sha256": F.sha2("payload", 256),
            "place": F.struct(
                F.col("page_id").isNull().alias("none"), "page_id", "record_id", "uri"
            ),
        }
    )
    groups = (
        known.where(F.octet_length("payload") >= min_bytes)
        .groupBy(*key)
        .agg(F.min("place").alias("first"), F.count(F.lit(1)).alias("n"))
        .where("n > 1")
        .drop("n")
    )
    path = new_shared_path(spark, "warc-first")
    groups.write.parquet(path)
    found = known.join(spark.read.parquet(path), key, "left")
    revisit = F.col("first").isNotNull() & (F.col("first.record_id") != F.col("record_id"))
    block = F.when(revisit, F.col("http_head")).otherwise(F.concat("http_head", "payload"))
    line = lambda name, value: F.concat(F.lit(f"{name}: "), value, F.lit("\r\n"))
    head = F.concat(
        F.lit("WARC/1.1\r\n"),
        line("WARC-Type", F.when(revisit, "revisit").otherwise("response")),
        line("WARC-Record-ID", F.col("record_id")),
        line("WARC-Date", F.col("date")),
        line("WARC-Target-URI", F.col("uri")),
        line("WARC-IP-Address", F.col("ip")),
        line("WARC-Payload-Digest", F.concat(F.lit("sha1:"), F.col("payload_digest"))),
        F.when(
            revisit,
            F.concat(
                line("WARC-Profile", F.lit(IDENTICAL)),
                line("WARC-Refers-To", F.col("first.record_id")),
                line("WARC-Refers-To-Target-URI", F.col("first.uri")),
                line(
                    "X-Refers-To-Page-Id",
                    F.coalesce(F.col("first.page_id").cast("string"), F.lit("")),
                ),
            ),
        ).otherwise(""),
        line("Content-Type", F.lit("application/http; msgtype=response")),
        line("Content-Length", F.octet_length(block).cast("string")),
        F.lit("\r\n"),
    )
    return found.select(F.concat(head.cast("binary"), block).cast("string").alias("value"))


def write_warc(records: DataFrame, path: str) -> None:
    """Archives of the records ``to_warc`` gives."""
    (
        records.write.option("lineSep", RECORD_END)
        .option("compression", "gzip")
        .option("maxRecordsPerFile", ARCHIVE_RECORDS)
        .text(path)
    )


# Reading WARC


def parse_warc(content: bytes) -> Iterator[tuple[bytes, bytes]]:
    """Head and block of each record."""
    at = 0
    while at < len(content):
        if content[at : at + 2] == b"\r\n":
            at += 2
            continue
        end = content.find(b"\r\n\r\n", at)
        if end < 0 or not content.startswith(b"WARC/", at):
            raise ValueError(f"no WARC record at byte {at}")
        head = content[at : end + 4]
        length = int(_header(head, "Content-Length") or 0)
        block = content[end + 4 : end + 4 + length]
        if len(block) != length:
            raise ValueError(f"WARC record at byte {at} ends before its declared length")
        yield head, block
        at = end + 4 + length


def read_warc(spark: SparkSession, path: str) -> DataFrame:
    """``[page_id, payload_bytes, payload_digest, record_type, refers_to]`` of the
    archives below ``path``. Size and digest are those of the full payload, for a
    revisit as its headers give them; a response is checked against its digest."""

    def rows(content: bytes) -> Iterator[tuple]:
        for head, block in parse_warc(content):
            http, payload = http_parts(block)
            kind = _header(head, "WARC-Type")
            digest = (_header(head, "WARC-Payload-Digest") or "").removeprefix("sha1:")
            if kind == "response" and digest != digest_of(payload):
                raise ValueError(f"digest of {_header(head, 'WARC-Record-ID')} differs")
            size = len(payload) if kind == "response" else _header(http, "Content-Length")
            page, first = _header(http, "X-Page-Id"), _header(head, "X-Refers-To-Page-Id")
            yield (
                int(page) if page else None,
                int(size or 0),
                digest,
                kind,
                int(first) if first else None,
                200,
            )

    fields = [
        ("page_id", pa.int64()),
        ("payload_bytes", pa.int64()),
        ("payload_digest", pa.string()),
        ("record_type", pa.string()),
        ("refers_to", pa.int64()),
    ]
    return _archives(spark, path).mapInArrow(_parsing(rows, fields), READ.format(id="long"))


def convert_pages(pages: DataFrame, min_bytes: int = 0) -> DataFrame:
    """``read_warc`` of the archives that ``pages`` give, by way of ARC.

    ``pages`` has whole-number ``page_id``, ``url`` and ``html``; other columns are
    ignored. Null html is empty, a null url ``-``, a null id stays null. Of pages that agree
    in all three, one is the response. An empty table gives no rows."""
    spark = pages.sparkSession
    arc, warc = new_shared_path(spark, "arc"), new_shared_path(spark, "warc")
    write_arc(pages.select("page_id", "url", "html"), arc)
    write_warc(to_warc(read_arc(spark, arc), min_bytes), warc)
    return read_warc(spark, warc)
