"""Legacy ARC archives: written, parsed, converted to WARC, and WARC read back.

An ARC record is one header line (five fields in version 1, ten in version 2, the last of
them the declared length), then that many bytes. The converter gives each the record a
WARC writer would have made: an identifier, a date, a type, digests of block and payload,
and a revisit record where an earlier record has the same payload.

Archives are written by Spark's text writer (UTF-8 bytes as they are, gzip), and read with
the binaryFile source, so they lie wherever Spark can write, and a lost task writes its
file again. A task reads one archive at a time, as it is decompressed.
"""

from __future__ import annotations

import base64
import hashlib
import re
import unicodedata
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from meterloom.llm.shared import staged

# Fields of the ARC versions, and the first lines of WARC records.
ARC_FIELDS = {
    1: "URL IP-address Archive-date Content-type Archive-length",
    2: "URL IP-address Archive-date Content-type Result-code Checksum Location Offset Filename"
    " Archive-length",
}
WARC_LINE = "WARC/1.1"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
ROW_HEADER = "X-Archive-Row"

# What is escaped in a URL: control characters, and what is white space to Python or Java.
BLANK = [
    c for c in map(chr, range(0x3001)) if c.isspace() or unicodedata.category(c) in ("Cc", "Zs", "Zl", "Zp")
]

CHUNK = 1 << 20
IDS_SENT = 500_000
BATCH_BYTES = 4 << 20
COMPRESSION = {"compression": "gzip", "zlib.compress.level": "BEST_SPEED"}

ARC_SCHEMA = T.StructType(
    [
        T.StructField("archive", T.StringType()),
        T.StructField("offset", T.LongType()),
        T.StructField("version", T.IntegerType()),
        T.StructField("url", T.StringType()),
        T.StructField("ip", T.StringType()),
        T.StructField("date", T.StringType()),
        T.StructField("mime", T.StringType()),
        T.StructField("kind", T.StringType()),
        T.StructField("row", T.LongType()),
        T.StructField("record_id", T.StringType()),
        T.StructField("payload_digest", T.StringType()),
        T.StructField("payload_bytes", T.LongType()),
        T.StructField("block_digest", T.StringType()),
        T.StructField("truncated", T.BooleanType()),
        T.StructField("head", T.BinaryType()),
        T.StructField("payload", T.BinaryType()),
        T.StructField("passed_over", T.LongType()),
    ]
)
WARC_SCHEMA = T.StructType(
    [
        T.StructField("record_id", T.StringType()),
        T.StructField("record_type", T.StringType()),
        T.StructField("refers_to_id", T.StringType()),
        T.StructField("uri", T.StringType()),
        T.StructField("date", T.StringType()),
        T.StructField("row", T.LongType()),
        T.StructField("payload_digest", T.StringType()),
        T.StructField("payload_bytes", T.LongType()),
        T.StructField("digest_holds", T.BooleanType()),
        T.StructField("payload", T.BinaryType()),
    ]
)


def write_arc(
    df: DataFrame, path: str, *, row: str, url: str, body: str, fetched: str = "20240101000000"
) -> None:
    """Write a row as an HTTP response in ARC archives, of both versions in turn.

    ``row`` goes into a header of the response (empty for null). White space and control
    characters in a URL, Unicode's too, are escaped as their UTF-8 bytes, a null or empty URL is ``unknown:``, a null body is empty. Rows that are repeated are
    records of their own; of the same row number and payload, the first one read is the
    response. An empty table gives archives without such records.
    """
    payload = F.coalesce(F.col(body).cast("binary"), F.lit(b""))
    address = F.coalesce(F.col(url), F.lit("unknown:"))
    escaped = address
    for c in BLANK:
        escaped = F.replace(escaped, F.lit(c), F.lit("".join(f"%{b:02X}" for b in c.encode())))
    any_of = "[" + "".join(f"\\x{{{ord(c):x}}}" for c in BLANK) + "]"
    address = F.when(address.rlike(any_of), escaped).otherwise(address)
    # Names that mean something else in an archive are set apart.
    address = F.when(address == "", "unknown:").when(
        address.rlike("^(filedesc|dns):"), F.concat(F.lit("urn:"), address)
    ).otherwise(address)
    http = F.concat(
        F.lit("HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=UTF-8\r\nContent-Length: "),
        F.octet_length(payload).cast("string"),
        F.lit(f"\r\n{ROW_HEADER}: "),
        F.coalesce(F.col(row).cast("string"), F.lit("")),
        F.lit("\r\n\r\n"),
    )
    length = (F.octet_length(http) + F.octet_length(payload)).cast("string")
    first = F.monotonically_increasing_id().bitwiseAND((1 << 33) - 1) == 0
    older = F.spark_partition_id() % 2 == 0
    line = F.concat_ws(" ", address, F.lit("0.0.0.0"), F.lit(fetched), F.lit("text/html"))
    line = F.when(older, F.concat_ws(" ", line, length)).otherwise(
        F.concat_ws(" ", line, F.lit("200 - - 0 -"), length)
    )

    def opening(version: int) -> str:
        about = f"{version} 0 meterloom\n{ARC_FIELDS[version]}\n"
        middle = "" if version == 1 else " 200 - - 0 -"
        return f"filedesc://rows.arc 0.0.0.0 {fetched} text/plain{middle} {len(about)}\n{about}\n"

    start = F.when(first, F.when(older, opening(1)).otherwise(opening(2))).otherwise(F.lit(""))
    df.select(F.concat(start, line, F.lit("\n"), http, payload.cast("string"))).write.options(
        lineSep="\n", **COMPRESSION
    ).text(path)


def _inflated(content: bytes) -> Iterator[bytes]:
    """The bytes of an archive in pieces; gzip members follow each other."""
    if content[:2] != b"\x1f\x8b":
        for at in range(0, len(content), CHUNK):
            yield content[at : at + CHUNK]
        return
    rest = content
    while rest:
        inflate = zlib.decompressobj(31)
        while not inflate.eof:
            piece = inflate.decompress(rest, CHUNK)
            rest = inflate.unconsumed_tail
            if piece:
                yield piece
            elif not rest:
                break  # cut off in the middle of a member
        rest = inflate.unused_data or rest


class _Reader:
    """Lines and counted bytes of an archive; at most a record is held."""

    def __init__(self, content: bytes) -> None:
        self.pieces, self.held, self.at, self.offset = _inflated(content), b"", 0, 0

    def _more(self) -> bool:
        piece = next(self.pieces, None)
        if piece is not None:
            self.held, self.at = self.held[self.at :] + piece, 0
        return piece is not None

    def line(self) -> bytes | None:
        """The next line without its end; None at the end of the archive."""
        seen = self.at
        while (end := self.held.find(b"\n", seen)) < 0:
            seen = len(self.held) - self.at
            if not self._more():
                end = len(self.held)
                break
        if self.at == len(self.held):
            return None
        out = self.held[self.at : end]
        self.offset += min(end + 1, len(self.held)) - self.at
        self.at = min(end + 1, len(self.held))
        return out.rstrip(b"\r")

    def take(self, n: int) -> bytes:
        """The next n bytes, or what is left."""
        parts, have = [], 0
        while have < n:
            if self.at == len(self.held) and not self._more():
                break
            part = self.held[self.at : self.at + n - have]
            parts.append(part)
            have += len(part)
            self.at += len(part)
        self.offset += have
        return parts[0] if len(parts) == 1 else b"".join(parts)


def _digest(data: bytes) -> str:
    return base64.b32encode(hashlib.sha1(data).digest()).decode()


def _http_parts(block: bytes) -> tuple[bytes, bytes]:
    """Head (with the blank line) and body of an HTTP message; all is body if it is none."""
    if not block.startswith(b"HTTP/"):
        return b"", block
    for end in (b"\r\n\r\n", b"\n\n"):
        if (at := block.find(end)) >= 0:
            return block[: at + len(end)], block[at + len(end) :]
    return block, b""


def _row_of(head: bytes) -> int | None:
    found = re.search(rb"(?im)^" + ROW_HEADER.encode() + rb":[ \t]*(-?\d+)[ \t]*\r?$", head)
    return int(found[1]) if found else None


_ARC_LINE = {
    1: re.compile(r"([^ ].*) (\S+) (\d{8,17}) (\S+) (\d+)"),
    2: re.compile(r"([^ ].*) (\S+) (\d{8,17}) (\S+) \S+ \S+ \S+ \S+ \S+ (\d+)"),
}


def arc_records(archive: str, content: bytes, payloads: bool) -> Iterator[tuple]:
    """The records of one archive, as rows of ``ARC_SCHEMA``.

    The version block says which fields a header line has; without one, the line does. A
    line that is no header is passed over; those with anything in them are counted in the
    record before (``passed_over``; in the first one, also those before it), and an archive
    that has nothing else is an error. A length beyond the end is kept as truncated.
    """
    reader, version = _Reader(content), 0
    last, passed = None, 0
    while True:
        offset = reader.offset
        line = reader.line()
        if line is None:
            if last:
                yield (*last, passed)
            elif passed:
                raise ValueError(f"{archive}: no ARC header in {passed} lines")
            return
        text = line.decode("utf-8", "replace")
        found = None
        for v in [version] if version else [2, 1]:
            found = found or _ARC_LINE[v].fullmatch(text)
        if not found:
            passed += bool(line.strip())
            continue
        if last:
            yield (*last, passed)
            passed = 0
        url, ip, date, mime, length = found.groups()
        block = reader.take(int(length))
        if url.startswith("filedesc:"):
            version = 2 if block[:1] == b"2" else 1
        bare = url.startswith(("filedesc:", "dns:"))
        head, payload = (b"", block) if bare else _http_parts(block)
        kind = (
            "warcinfo" if url.startswith("filedesc:") else "response" if head else "resource"
        )
        made = hashlib.md5(f"{archive}:{offset}:{url}:{date}".encode()).hexdigest()
        name = "-".join((made[:8], made[8:12], "5" + made[13:16], "8" + made[17:20], made[20:]))
        last = (
            archive, offset, version, url, ip, date, mime, kind, _row_of(head),
            f"<urn:uuid:{name}>", _digest(payload), len(payload), _digest(block),
            len(block) < int(length), head, payload if payloads else None,
        )


def warc_records(content: bytes, payloads: bool) -> Iterator[tuple]:
    """The records of one WARC archive, as rows of ``WARC_SCHEMA``."""
    reader = _Reader(content)
    while (line := reader.line()) is not None:
        if not line.startswith(b"WARC/"):
            continue
        fields = {}
        while line := reader.line():
            name, _, value = line.decode("utf-8", "replace").partition(":")
            fields[name.strip().lower()] = value.strip()
        block = reader.take(int(fields.get("content-length", 0)))
        head, payload = _http_parts(block)
        kind = fields.get("warc-type")
        told = fields.get("warc-payload-digest", "").removeprefix("sha1:")
        size, digest = len(payload), _digest(payload)
        if kind == "revisit":
            found = re.search(rb"(?im)^content-length:[ \t]*(\d+)", head)
            size, digest = int(found[1]) if found else None, told
        yield (
            fields.get("warc-record-id"), kind, fields.get("warc-refers-to"),
            fields.get("warc-target-uri"), fields.get("warc-date"), _row_of(head), digest, size,
            digest == told, payload if payloads else None,
        )


def _read(spark: SparkSession, path: str, parse, schema: T.StructType) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kinds = [_ARROW[f.dataType.typeName()] for f in schema]

        def batch(rows: list[tuple]) -> pa.RecordBatch:
            columns = zip(*rows) if rows else ([] for _ in kinds)
            arrays = [pa.array(c, k) for c, k in zip(columns, kinds)]
            return pa.RecordBatch.from_arrays(arrays, schema.names)

        for found in batches:
            for archive, content in zip(found.column("path"), found.column("content")):
                rows, held = [], 0
                for row in parse(archive.as_py(), content.as_py()):
                    rows.append(row)
                    held += 200 + sum(len(x) for x in row if isinstance(x, bytes))
                    if held >= BATCH_BYTES:
                        yield batch(rows)
                        rows, held = [], 0
                yield batch(rows)

    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(path)
    return files.select("path", "content").mapInArrow(run, schema)


_ARROW = {
    "string": pa.string(), "long": pa.int64(), "integer": pa.int32(), "boolean": pa.bool_(),
    "binary": pa.binary(),
}


def read_arc(spark: SparkSession, path: str, payloads: bool = True) -> DataFrame:
    return _read(spark, path, lambda a, c: arc_records(a, c, payloads), ARC_SCHEMA)


def read_warc(spark: SparkSession, path: str, payloads: bool = True) -> DataFrame:
    return _read(spark, path, lambda _, c: warc_records(c, payloads), WARC_SCHEMA)


def warc_date(date: Column) -> Column:
    """The 14 digits of an ARC date as a WARC date; shorter ones are filled up."""
    full = F.rpad(F.substring(date, 1, 14), 14, "0")
    pieces = [F.substring(full, a, n) for a, n in ((1, 4), (5, 2), (7, 2), (9, 2), (11, 2), (13, 2))]
    return F.concat(
        F.concat_ws("-", *pieces[:3]), F.lit("T"), F.concat_ws(":", *pieces[3:]), F.lit("Z")
    )


def warc_text(r: DataFrame) -> Column:
    """A WARC record without its last blank lines. ``r``: ``ARC_SCHEMA`` and ``first_*``."""
    revisit = F.col("first_id").isNotNull()
    kind = F.when(revisit, "revisit").otherwise(F.col("kind"))
    block = F.when(revisit, F.col("head")).otherwise(F.concat("head", "payload"))

    def field(name: str, value: Column) -> Column:
        return F.when(value.isNotNull(), F.concat(F.lit(f"{name}: "), value, F.lit("\r\n"))).otherwise("")

    http = F.octet_length("head") > 0
    return F.concat(
        F.lit(f"{WARC_LINE}\r\n"),
        field("WARC-Type", kind),
        field("WARC-Record-ID", F.col("record_id")),
        field("WARC-Target-URI", F.when(F.col("kind") != "warcinfo", F.col("url"))),
        field("WARC-Date", warc_date(F.col("date"))),
        field("WARC-IP-Address", F.when(F.col("ip") != "0.0.0.0", F.col("ip"))),
        field("WARC-Payload-Digest", F.concat(F.lit("sha1:"), F.col("payload_digest"))),
        field("WARC-Block-Digest", F.when(~revisit, F.concat(F.lit("sha1:"), F.col("block_digest")))),
        field("WARC-Profile", F.when(revisit, PROFILE)),
        field("WARC-Refers-To", F.col("first_id")),
        field("WARC-Truncated", F.when(F.col("truncated"), "length")),
        field(
            "Content-Type",
            F.when(http, "application/http;msgtype=response").otherwise(F.col("mime")),
        ),
        field("Content-Length", F.octet_length(block).cast("string")),
        F.lit("\r\n"),
        block.cast("string"),
    )


def convert(spark: SparkSession, arc_path: str, warc_path: str, least_bytes: int = 0) -> None:
    """Write the WARC archives for the ARC archives under ``arc_path``.

    Of response records with the same payload, of ``least_bytes`` or more, the first (the
    smallest row, or else archive and offset) keeps it; the others become revisits of it.
    The archives are parsed twice: for digests, then for payloads. Only ids and digests
    are grouped, combined before the shuffle. The ids of revisits (about 100 bytes each) are
    sent to the readers of the payloads up to half a million; beyond that payloads move
    once, to be joined with them. Empty archives give none.
    """
    rank = F.struct(F.coalesce("row", F.lit((1 << 63) - 1)), "archive", "offset", "record_id")
    facts = read_arc(spark, arc_path, payloads=False).filter(
        (F.col("kind") == "response") & (F.col("payload_bytes") >= least_bytes)
    ).select("payload_digest", "record_id", rank.alias("rank"))
    firsts = facts.groupBy("payload_digest").agg(
        F.min("rank").alias("first"), F.count(F.lit(1)).alias("n")
    ).filter("n > 1")
    revisits = facts.join(firsts, "payload_digest").filter(
        F.col("record_id") != F.col("first.record_id")
    ).select("record_id", F.col("first.record_id").alias("first_id"))
    revisits = staged(revisits, "revisits")
    if revisits.count() <= IDS_SENT:
        revisits = F.broadcast(revisits)
    records = read_arc(spark, arc_path).join(revisits, "record_id", "left")
    records.select(warc_text(records)).write.options(lineSep="\r\n\r\n", **COMPRESSION).text(warc_path)
