"""WARC archives of web pages: written with one gzip member per record, read back by byte ranges.

Equal payloads are stored once: the record of the largest page id is the response, the others revisit it.
Spark's text writer puts the members into files, so that its commit protocol and any of its file systems serve;
the byte it sets after every line is the last byte of the member before it.

The reader needs no index. A task scans its byte range for the gzip magic, decodes the first bytes of a candidate
and takes it as a record if they are a WARC header. It owns the records that start inside its range, wherever
they end, and goes on after the end of each.
"""

from __future__ import annotations

import base64
import hashlib
import zlib
from collections.abc import Iterator

import pyarrow as pa
import pyarrow.fs
from pyspark.sql import DataFrame, SparkSession, functions as F

from tallyloom.functions.staging import stage
from tallyloom.llm.tables import slices

MAGIC, WINDOW, SPLIT_BYTES, SLICE = b"\x1f\x8b\x08", 1 << 20, 16 << 20, 16_000_000
MOST_HELD = 1 << 24  # the last byte of a gzip member is 0 if it holds less than 16 MiB
REVISIT = "http://netpreserve.org/warc/1.0/revisit/identical-payload-digest"
DATE = "1970-01-01T00:00:00Z"  # pages carry no fetch time


def record_types(pages: DataFrame, min_bytes: int = 0) -> DataFrame:
    """``pages`` plus ``refers_to``: the largest page id with an equal payload of at least ``min_bytes`` bytes, if
    that is another one. Rows without an id refer to a page that has one."""
    payload = F.coalesce("html", F.lit(""))
    hashed = pages.select("page_id", "url", "html", F.sha1(payload.cast("binary")).alias("digest"))
    large = hashed.where(F.octet_length(payload) >= min_bytes)
    firsts = large.groupBy("digest").agg(F.max("page_id").alias("first"), F.count(F.lit(1)).alias("n"))
    shared = stage(firsts.where("n > 1").drop("n"), "payloads")
    other = F.when(~F.col("first").eqNullSafe(F.col("page_id")), F.col("first"))
    return hashed.join(shared, "digest", "left").select("page_id", "url", "html", other.alias("refers_to"))


def record(page_id: int | None, url: str | None, html: str | None, refers_to: int | None) -> bytes:
    payload = (html or "").encode()
    digest = base64.b32encode(hashlib.sha1(payload).digest()).decode()
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    block = http if refers_to is not None else http + payload
    # Characters that could break a header line are percent-encoded.
    target = "".join(c if c.isprintable() else "".join(f"%{b:02X}" for b in c.encode()) for c in url or "")
    lines = [
        "WARC/1.0",
        f"WARC-Type: {'response' if refers_to is None else 'revisit'}",
        f"WARC-Record-ID: <urn:page:{'none' if page_id is None else page_id}>",
        f"WARC-Date: {DATE}",
        *([] if url is None else [f"WARC-Target-URI: {target}"]),
        f"WARC-Payload-Digest: sha1:{digest}",
        *([] if refers_to is None else [f"WARC-Refers-To: <urn:page:{refers_to}>", f"WARC-Profile: {REVISIT}"]),
        "Content-Type: application/http; msgtype=response",
        f"Content-Length: {len(block)}",
    ]
    return "\r\n".join(lines).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"


def _member(data: bytes) -> bytes:
    packer = zlib.compressobj(6, zlib.DEFLATED, 31)
    return packer.compress(data) + packer.flush()


def write_archives(pages: DataFrame, path: str, min_bytes: int = 0) -> None:
    """Write ``page_id``, ``url`` and ``html`` (UTF-8; null as empty) as records to files under ``path``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "html", SLICE):
            members = []
            for row in batch.to_pylist():
                data = record(**row)
                member = _member(data)
                # After a larger record an empty member follows, for its last byte is 0 in any case.
                members.append((member if len(data) < MOST_HELD else member + _member(b""))[:-1])
            yield pa.RecordBatch.from_arrays([pa.array(members, pa.binary())], ["member"])

    members = record_types(pages, min_bytes).mapInArrow(run, "member binary")
    members.select(F.col("member").cast("string").alias("value")).write.option("lineSep", "\0").text(path)


def _open(uri: str) -> pa.NativeFile:
    if uri.startswith("file:/") and not uri.startswith("file:///"):
        uri = "file://" + uri[5:]
    system, place = pa.fs.FileSystem.from_uri(uri)
    return system.open_input_file(place)


def _inflated(file: pa.NativeFile, start: int) -> tuple[bytes, int] | None:
    """The record whose member begins at ``start`` and the place after it, or None if none begins there."""
    unpack, parts, place, checked = zlib.decompressobj(31), [], start, b""
    while not unpack.eof:
        data = file.read_at(4096 if place == start else WINDOW, place)
        if not data:
            return None
        try:
            parts.append(unpack.decompress(data))
        except zlib.error:
            return None
        place += len(data)
        if len(checked) < 7:
            checked = b"".join(parts)[:7]
            if not b"WARC/1.".startswith(checked):
                return None
    if checked != b"WARC/1.":
        return None
    return b"".join(parts), place - len(unpack.unused_data)


def records_in(file: pa.NativeFile, start: int, stop: int) -> Iterator[bytes]:
    """The records that start at ``start`` or later and before ``stop``."""
    place = start
    while place < stop:
        data = file.read_at(min(WINDOW, stop - place) + len(MAGIC) - 1, place)
        at = data.find(MAGIC)
        if at < 0:
            place += max(1, len(data) - len(MAGIC) + 1)
            if len(data) < len(MAGIC):
                return
            continue
        place += at
        if place >= stop:
            return
        found = _inflated(file, place)
        if found:
            yield found[0]
            place = found[1]
        else:
            place += 1


def parse_record(data: bytes) -> dict:
    """The fields of a record. A response's payload must have the length and digest that its headers name."""
    head, _, rest = data.partition(b"\r\n\r\n")
    named = dict(line.split(": ", 1) for line in head.decode().split("\r\n")[1:])
    block = rest[: int(named["Content-Length"])]
    http, _, payload = block.partition(b"\r\n\r\n")
    sizes = [line.split(b":", 1)[1] for line in http.split(b"\r\n") if line.lower().startswith(b"content-length:")]
    digest = named["WARC-Payload-Digest"].removeprefix("sha1:")
    revisit = named["WARC-Type"] == "revisit"
    if not revisit and (
        len(payload) != int(sizes[0]) or base64.b32encode(hashlib.sha1(payload).digest()).decode() != digest
    ):
        raise ValueError(f"damaged record {named['WARC-Record-ID']}")

    def page(name: str) -> int | None:
        found = named.get(name, "none").removeprefix("<urn:page:").removesuffix(">")
        return None if found == "none" else int(found)

    return {
        "page_id": page("WARC-Record-ID"),
        "url": named.get("WARC-Target-URI"),
        "payload": None if revisit else payload,
        "payload_bytes": int(sizes[0]),
        "payload_digest": digest,
        "record_type": named["WARC-Type"],
        "refers_to": page("WARC-Refers-To"),
    }


FIELDS = {
    "page_id": "long",
    "url": "string",
    "payload": "binary",
    "payload_bytes": "long",
    "payload_digest": "string",
    "record_type": "string",
    "refers_to": "long",
}


def byte_ranges(spark: SparkSession, path: str, split_bytes: int = SPLIT_BYTES) -> DataFrame:
    """(path, start, stop) over all archive files; only the files' names and lengths are read here."""
    files = spark.read.format("binaryFile").option("pathGlobFilter", "part-*").load(path).select("path", "length")
    starts = F.explode(F.sequence(F.lit(0).cast("long"), F.col("length") - 1, F.lit(split_bytes).cast("long")))
    ranges = files.where("length > 0").select("path", "length", starts.alias("start"))
    return ranges.select("path", "start", F.least("length", F.col("start") + split_bytes).alias("stop"))


def read_archives(
    spark: SparkSession, path: str, columns: list[str] | None = None, split_bytes: int = SPLIT_BYTES
) -> DataFrame:
    """One row per record of the archives under ``path`` with the given ``columns`` of ``FIELDS`` (all by default;
    a revisit has no payload). A folder without records gives no rows."""
    names = columns or list(FIELDS)
    schema = ", ".join(f"{n} {FIELDS[n]}" for n in names)
    kinds = {"long": pa.int64(), "string": pa.string(), "binary": pa.binary()}
    target = pa.schema([(n, kinds[FIELDS[n]]) for n in names])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                held, size = [], 0
                with _open(row["path"]) as file:
                    for data in records_in(file, row["start"], row["stop"]):
                        held.append({n: v for n, v in parse_record(data).items() if n in names})
                        size += len(data)
                        if size >= SLICE:
                            yield pa.RecordBatch.from_pylist(held, target)
                            held, size = [], 0
                if held:
                    yield pa.RecordBatch.from_pylist(held, target)

    ranges = byte_ranges(spark, path, split_bytes)
    return ranges.repartition(max(1, ranges.count())).mapInArrow(run, schema)
