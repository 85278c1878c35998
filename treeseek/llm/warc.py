"""WARC archives: written by Spark's own sink, read in byte ranges.

Writing. Each record is a gzip member of its own. Members are binary, yet they
go through the text sink and so through Spark's commit protocol, to any file
system that Spark can write to, whole and once however often a task runs: the
last byte of a member is the highest byte of its length, which is zero below
16 MB, and a zero byte is what the sink puts after each record. Longer blocks
are split into segments, as the format provides (continuation records).

Payloads of some size that occur more than once are stored once: the record with
the largest id is a response, the others revisit it.

Reading. A file is cut into byte ranges. A task scans its range for the gzip
magic, takes a candidate for a member if it decodes to the header of a record,
and from there goes from member to member. It owns the records that start inside
its range and reads beyond the end to complete the last one. What is no member
is skipped to the next candidate. The writer makes sure that no member contains
what looks like another one, say where a payload is an archive itself.

Defined results: a null payload is empty; a null target address is left out of
the record; a record with a null id is written with an empty one, read back as
null and never referred to; equal rows with the largest id are responses all; no
records make archives without records, read as an empty table; other columns
are not written. A header of more than 8 MB cannot be written and is an error.
"""

from __future__ import annotations

import base64
import hashlib
import re
import zlib
from collections.abc import Iterator
from urllib.parse import quote, unquote

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from treeseek.llm.rows import HOT_ROWS, sieve, sifted
from treeseek.operators.skew import hot_keys, join_unique
from treeseek.session import materialise, materialise_counted, spread

REVISIT_BYTES = 1000
SEGMENT_BYTES = 8 << 20
RANGE_BYTES = 32 << 20
_READ = 1 << 20
_WINDOW = 64 << 10
_MAGIC = b"\x1f\x8b\x08"
_URN = "urn:record:"
_LEVEL = 3

_ROW = (
    "id string, record_type string, uri string, payload_bytes bigint, payload_digest string, refers_to string, "
    "segment int, origin string, payload binary"
)


# Writing


def _header(fields: list[tuple[str, str]]) -> bytes:
    lines = ["WARC/1.1", *(f"{name}: {value}" for name, value in fields if value)]
    return ("\r\n".join(lines) + "\r\n\r\n").encode()


def _name(identifier: str | None, segment: int = 1) -> str:
    return f"<{_URN}{quote(identifier or '', safe='')}{f'/{segment}' if segment > 1 else ''}>"


def _member(record: bytes) -> bytes:
    """A gzip member in which nothing looks like the start of another one."""
    for level, strategy in (
        (_LEVEL, zlib.Z_DEFAULT_STRATEGY), (9, zlib.Z_DEFAULT_STRATEGY), (9, zlib.Z_HUFFMAN_ONLY), (9, zlib.Z_FIXED)
    ):
        packer = zlib.compressobj(level, zlib.DEFLATED, 31, 8, strategy)
        member = packer.compress(record) + packer.flush()
        at = member.find(_MAGIC, 1)
        while at > 0 and not starts_record(member[at : at + _WINDOW]):
            at = member.find(_MAGIC, at + 1)
        if at < 0:
            return member
    raise ValueError("a record cannot be told from what is in it")


def members(
    identifier: str | None, uri: str | None, payload: bytes, digest: str, refers_to: str | None, date: str,
    segment_bytes: int = SEGMENT_BYTES,
) -> Iterator[bytes]:
    """The gzip members of one record."""
    http = (
        "HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n" f"Content-Length: {len(payload)}\r\n\r\n"
    ).encode()
    block = http if refers_to is not None else http + payload
    cuts = range(0, len(block), segment_bytes)
    for number, start in enumerate(cuts, 1):
        part = block[start : start + segment_bytes]
        fields = [
            ("WARC-Type", "continuation" if number > 1 else "response" if refers_to is None else "revisit"),
            ("WARC-Record-ID", _name(identifier, number)),
            ("WARC-Date", date),
        ]
        if number == 1:
            target = re.sub(r"[\x00-\x20\x7f]", lambda m: quote(m.group()), uri or "")
            fields += [
                ("WARC-Target-URI", target),
                ("WARC-Payload-Digest", "sha1:" + base64.b32encode(bytes.fromhex(digest)).decode()),
            ]
            if refers_to is not None:
                profile = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
                fields += [("WARC-Profile", profile), ("WARC-Refers-To", _name(refers_to))]
        if len(cuts) > 1:
            fields.append(("WARC-Segment-Number", str(number)))
            if number > 1:
                fields.append(("WARC-Segment-Origin-ID", _name(identifier)))
            if number == len(cuts):
                fields.append(("WARC-Segment-Total-Length", str(len(block))))
        fields += [("Content-Type", "application/http; msgtype=response"), ("Content-Length", str(len(part)))]
        record = _header(fields) + part + b"\r\n\r\n"
        if len(record) >= 1 << 24:
            raise ValueError("a record's header is too long")
        yield _member(record)


def resolve_revisits(records: DataFrame, least: int = REVISIT_BYTES, hot: int = HOT_ROWS) -> DataFrame:
    """(id, uri, payload) with ``digest`` and ``refers_to``, the id of the record that has the payload.

    Digests alone are compared across records. Only payloads that a sieve of
    the repeated digests lets through are shuffled.
    """
    held = records.select("id", "uri", F.coalesce("payload", F.lit(b"")).alias("payload")).withColumns(
        {"digest": F.sha1("payload"), "same": F.sha2("payload", 256)}
    )
    groups = materialise(
        held.where(F.length("payload") >= least).groupBy("same")
        .agg(F.max("id").alias("holder"), F.count(F.lit(1)).alias("n")).where("n > 1"),
        "repeated-payloads",
    )
    large = hot_keys(groups.select("same", "n"), ["same"], hot)
    marked = sifted(held, F.xxhash64("same"), sieve(groups.select(F.xxhash64("same").alias("h"))))
    # The length is asked again: a shorter payload is never a revisit.
    joined = join_unique(
        marked.where("maybe").drop("maybe"), groups.select("same", "holder"), ["same"], large, ["id", "uri"], "left"
    )
    other = (F.length("payload") >= least) & ~F.col("holder").eqNullSafe(F.col("id"))
    told = joined.withColumn("refers_to", F.when(other, F.col("holder"))).drop("holder", "same")
    single = marked.where("not maybe").drop("maybe", "same")
    return single.withColumn("refers_to", F.lit(None).cast(records.schema["id"].dataType)).unionByName(told)


def write(
    records: DataFrame, path: str, least: int = REVISIT_BYTES, date: str = "2000-01-01T00:00:00Z",
    segment_bytes: int = SEGMENT_BYTES,
) -> None:
    """Write records (id, uri, payload) as archives below ``path``."""
    resolved = resolve_revisits(spread(records), least)
    texts = resolved.select(
        F.col("id").cast("string").alias("id"), "uri", "payload", "digest",
        F.col("refers_to").cast("string").alias("refers_to"),
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out, size = [], 0
            columns = [batch.column(c) for c in ("id", "uri", "payload", "digest", "refers_to")]
            for row in zip(*columns):
                for member in members(*(v.as_py() for v in row), date, segment_bytes):
                    out.append(member[:-1])
                    size += len(member)
                if size > 16 << 20:
                    yield pa.RecordBatch.from_arrays([pa.array(out, pa.binary())], names=["member"])
                    out, size = [], 0
            yield pa.RecordBatch.from_arrays([pa.array(out, pa.binary())], names=["member"])

    packed = texts.mapInArrow(run, "member binary").select(F.col("member").cast("string").alias("member"))
    packed.write.option("lineSep", "\u0000").text(path)


# Reading


def starts_record(data: bytes) -> bool:
    """Whether a gzip member starts here that holds a record: its header is decoded."""
    if len(data) < 18 or data[3] & 0xE0:
        return False
    try:
        head = zlib.decompressobj(31).decompress(data, 65536)
    except zlib.error:
        return False
    return head.startswith(b"WARC/1.") and b"\r\nWARC-Record-ID:" in head


def _fields(head: bytes) -> dict[str, str]:
    out = {}
    for line in head.decode("utf-8", "replace").split("\r\n")[1:]:
        name, found, value = line.partition(":")
        if found:
            out[name.lower()] = value.strip()
    return out


def records_in(file, start: int, end: int, size: int) -> Iterator[tuple[dict[str, str], bytes]]:
    """Header fields and block of the records whose members start in [start, end) of an open file."""
    held, first = b"", start  # the bytes of the file from ``first`` on

    def window(position: int) -> bytes:
        nonlocal held, first
        if position + _WINDOW > first + len(held) and first + len(held) < size:
            held, first = file.read_at(min(_READ, size - position), position), position
        return held[position - first : position - first + _WINDOW]

    at, sure = start, False  # sure: a member ended here
    while at < min(end, size):
        ahead = window(at)
        if not (ahead.startswith(_MAGIC) and (sure or starts_record(ahead))):
            found, sure = ahead.find(_MAGIC, 1), False
            # A magic may lie across two windows.
            at += found if found > 0 else max(1, len(ahead) - 2)
            continue
        unpacker, parts, position = zlib.decompressobj(31), [], at
        try:
            while not unpacker.eof and (ahead := window(position)):
                parts.append(unpacker.decompress(ahead))
                position += len(ahead)
        except zlib.error:
            pass
        if not unpacker.eof:
            at, sure = at + 1, False
            continue
        at, sure = position - len(unpacker.unused_data), True
        head, _, rest = b"".join(parts).partition(b"\r\n\r\n")
        if head.startswith(b"WARC/"):
            fields = _fields(head)
            length = fields.get("content-length", "")
            yield fields, rest[: int(length)] if length.isdigit() else rest.removesuffix(b"\r\n\r\n")


def _identifier(value: str | None) -> str | None:
    if value is None:
        return None
    inner = value.strip("<>")
    return unquote(inner.removeprefix(_URN)) or None if inner.startswith(_URN) else inner


def _row(fields: dict[str, str], block: bytes, payloads: bool) -> dict:
    segment = fields.get("warc-segment-number")
    row = {
        "id": _identifier(fields.get("warc-record-id")),
        "record_type": fields.get("warc-type"),
        "uri": fields.get("warc-target-uri"),
        "refers_to": _identifier(fields.get("warc-refers-to")),
        "segment": int(segment) if segment else None,
        "origin": _identifier(fields.get("warc-segment-origin-id") or (segment and fields.get("warc-record-id"))),
    }
    if segment:
        return row | {"payload_bytes": None, "payload_digest": fields.get("warc-payload-digest"), "payload": block}
    return row | _payload(row["record_type"], block, fields.get("warc-payload-digest"), payloads)


def _payload(kind: str | None, block: bytes, stated: str | None, payloads: bool) -> dict:
    """Length and digest of the full payload: measured where it is there, as stated where it is not."""
    http, _, payload = block.partition(b"\r\n\r\n")
    if kind == "revisit":
        length = re.search(rb"(?i)\r\ncontent-length: *(\d+)", http)
        digest = base64.b32decode(stated.partition(":")[2]).hex() if stated else None
        return {"payload_bytes": int(length[1]) if length else None, "payload_digest": digest, "payload": None}
    return {
        "payload_bytes": len(payload),
        "payload_digest": hashlib.sha1(payload).hexdigest(),
        "payload": payload if payloads else None,
    }


_ARROW = pa.schema([
    ("id", pa.string()), ("record_type", pa.string()), ("uri", pa.string()), ("payload_bytes", pa.int64()),
    ("payload_digest", pa.string()), ("refers_to", pa.string()), ("segment", pa.int32()), ("origin", pa.string()),
    ("payload", pa.binary()),
])


def _batched(rows: Iterator[dict]) -> Iterator[pa.RecordBatch]:
    held, size = [], 0
    for row in rows:
        held.append(row)
        size += 300 + len(row["payload"] or b"")
        if size > 16 << 20:
            yield pa.RecordBatch.from_pylist(held, schema=_ARROW)
            held, size = [], 0
    yield pa.RecordBatch.from_pylist(held, schema=_ARROW)


def read(spark: SparkSession, path: str, range_bytes: int = RANGE_BYTES, payloads: bool = True) -> DataFrame:
    """The records below ``path``: id, record_type, uri, payload_bytes, payload_digest (SHA-1), refers_to, payload.

    Without ``payloads`` they are measured and left behind.
    """
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(path).select("path", "length")
    starts = F.explode(F.sequence(F.lit(0), F.col("length") - 1, F.lit(range_bytes))).alias("start")
    ranges, n = materialise_counted(files.where("length > 0").select("path", "length", starts), "ranges")
    # A number that is asked for is kept; few rows would be put into one task else.
    ranges = ranges.repartition(max(1, n), "path", "start")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyarrow.fs import FileSystem

        def rows() -> Iterator[dict]:
            for batch in batches:
                for where, length, start in zip(*(batch.column(c).to_pylist() for c in ("path", "length", "start"))):
                    system, name = FileSystem.from_uri(re.sub(r"^file:/+", "file:///", where))
                    with system.open_input_file(name) as file:
                        for fields, block in records_in(file, start, min(start + range_bytes, length), length):
                            yield _row(fields, block, payloads)

        return _batched(rows())

    found = materialise(ranges.mapInArrow(run, _ROW), "records")
    parts = (
        found.where("segment is not null").groupBy("origin")
        .agg(
            F.min_by(F.struct("record_type", "uri", "payload_digest"), "segment").alias("first"),
            F.array_sort(F.collect_list(F.struct("segment", "payload"))).alias("parts"),
        )
        .select(
            F.col("origin").alias("id"), "first.record_type", "first.uri", "first.payload_digest",
            F.aggregate("parts", F.lit(b""), lambda whole, part: F.concat(whole, part["payload"])).alias("payload"),
        )
    )

    def joined(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        empty = {"refers_to": None, "segment": None, "origin": None}
        for batch in batches:
            yield from _batched(
                row | empty | _payload(row["record_type"], row["payload"], row["payload_digest"], payloads)
                for row in batch.to_pylist()
            )

    whole = parts.mapInArrow(joined, _ROW)
    return found.where("segment is null").unionByName(whole).drop("segment", "origin")
