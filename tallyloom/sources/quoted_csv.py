"""CSV files whose quoted fields hold line breaks, read in as many tasks as they have byte ranges.

Whether a line begins a record or goes on with a quoted field depends on all lines before it. So each task first
reads its range as if it began outside a quoted field and as if inside one, and says how it ends in either case; a
prefix over the ranges of a file then fixes how each one begins. Now each task cuts out the records that begin in
its range, reading on past its end for the last one, and Spark parses them.
"""

from __future__ import annotations

import codecs
from collections.abc import Iterator
from operator import itemgetter

import pyarrow as pa
import pyarrow.fs
from pyspark.sql import DataFrame, DataFrameReader, SparkSession, Window, functions as F, types as T

from tallyloom.functions.shipping import ship_package
from tallyloom.functions.staging import stage

#: Bytes of a range, of a block read at once, of the first one read beyond a range, and of the records sent to Spark at once.
RANGE_BYTES, BLOCK, BEYOND, SEND = 64 << 20, 4 << 20, 1 << 14, 2 << 20
#: Ranges go one to a task up to so many tasks for each core, then as many to a task as make up RANGE_BYTES.
TASKS_A_CORE = 4
BREAK, QUOTE, COMMA = b"\n", b'"', b","
#: Names of files that only one reader can unpack.
_PACKED = r"\.(gz|gzip|bz2|zst|zstd|lz4|snappy|deflate|xz)$"


def open_file(uri: str) -> pa.NativeFile:
    """A file by the name that Spark gives it."""
    if uri.startswith("file:/") and not uri.startswith("file:///"):
        uri = "file://" + uri.removeprefix("file:")
    system, place = pa.fs.FileSystem.from_uri(uri)
    return system.open_input_file(place)


def ends_inside(line: bytes, inside: bool) -> bool:
    """Whether a quoted field is open after ``line``, given whether one is before it.

    Only a quote that begins a field opens it, doubled quotes belong to it, and after a closing quote anything up to
    the next comma does, too.
    """
    at = 0
    while True:
        if not inside:
            if not line.startswith(QUOTE, at):
                at = line.find(COMMA, at) + 1
                if not at:
                    return False
                continue
            inside, at = True, at + 1
        at = line.find(QUOTE, at) + 1
        if not at:
            return True
        if line.startswith(QUOTE, at):
            at += 1
            continue
        inside, at = False, line.find(COMMA, at) + 1
        if not at:
            return False


def _whole_lines(file: pa.NativeFile, place: int, stop: int) -> Iterator[tuple[int, bytes]]:
    """(place, lines) from a place at which a line begins to the end of the file, some whole lines at a time: as much as
    there is up to ``stop``, where the range ends, and little at first beyond it, where mostly one line is wanted."""
    size, more = file.size(), min(BEYOND, BLOCK)
    while place < size:
        parts, read, end = [], place, 0
        while not end and read < size:
            if read < stop:
                wanted = min(BLOCK, stop - read)
            else:
                wanted, more = more, min(2 * more, BLOCK)
            data = file.read_at(min(wanted, size - read), read)
            end = data.rfind(BREAK) + 1 if read + len(data) < size else len(data)
            parts.append(data[:end] if end else data)
            read += len(parts[-1])
        yield place, b"".join(parts)
        place = read


def _first_line(file: pa.NativeFile, start: int) -> int:
    """Where the first line begins that does so at ``start`` or later."""
    if not start:
        return 0
    place, more = start - 1, min(BEYOND, BLOCK)
    while data := file.read_at(more, place):
        at = data.find(BREAK)
        if at >= 0:
            return place + at + 1
        place, more = place + len(data), min(2 * more, BLOCK)
    return place


def _own_length(place: int, lines: bytes, stop: int) -> int:
    """How much of ``lines``, which begin at ``place``, are lines that begin before ``stop``."""
    if place >= stop:
        return 0
    if place + len(lines) <= stop:
        return len(lines)
    return lines.find(BREAK, stop - 1 - place) + 1 or len(lines)


def _line_at(lines: bytes, at: int) -> tuple[int, int]:
    """Where the line that holds ``at`` begins and ends, its break included."""
    return lines.rfind(BREAK, 0, at) + 1, lines.find(BREAK, at) + 1 or len(lines)


def range_ends(file: pa.NativeFile, start: int, stop: int) -> tuple[bool, bool]:
    """Whether a quoted field is open after the lines that begin in a range, if none was before and if one was."""
    outside, inside = False, True
    for place, lines in _whole_lines(file, _first_line(file, start), stop):
        length = _own_length(place, lines, stop)
        at = lines.find(QUOTE, 0, length)
        while at >= 0:  # lines without quotes change nothing
            begin, end = _line_at(lines, at)
            outside, inside = (ends_inside(lines[begin:end], state) for state in (outside, inside))
            at = lines.find(QUOTE, end, length)
        if length < len(lines):
            break
    return outside, inside


def range_records(file: pa.NativeFile, start: int, stop: int, inside: bool) -> Iterator[bytes]:
    """The records that begin in a range, without their last line break; ``inside`` says how the range begins."""
    held: list[bytes] = []
    foreign = inside  # the range begins in a record of an earlier one
    for place, lines in _whole_lines(file, _first_line(file, start), stop):
        at, length = 0, _own_length(place, lines, stop)
        if foreign and not length:
            return
        while at < len(lines):
            if not inside:
                if at >= length:
                    return
                quote = lines.find(QUOTE, at, length)
                plain = length if quote < 0 else _line_at(lines, quote)[0]
                if plain > at:
                    yield from lines[at:plain].removesuffix(BREAK).split(BREAK)
                    at = plain
                    continue
            begin, end = _line_at(lines, at)
            line = lines[begin:end]
            inside = ends_inside(line, inside)
            if not foreign:
                held.append(line)
            if not inside:
                if held:
                    yield b"".join(held).removesuffix(BREAK)
                    held.clear()
                foreign = False
            at = end
            if foreign and place + at >= stop:
                return  # the whole range lies in that record
    if held:
        yield b"".join(held)


def byte_ranges(spark: SparkSession, path: str, range_bytes: int) -> DataFrame:
    """(path, start, stop) over all files; only their names and lengths are read here."""
    files = spark.read.format("binaryFile").load(path).select("path", "length").where("length > 0")
    starts = F.explode(F.sequence(F.lit(0).cast("long"), F.col("length") - 1, F.lit(range_bytes).cast("long")))
    return files.select("path", "length", starts.alias("start")).select(
        "path", "start", F.least("length", F.col("start") + range_bytes).alias("stop")
    )


def _with_beginnings(ends: DataFrame) -> DataFrame:
    """Ranges with ``inside``, whether they begin in a quoted field.

    A range that ends alike in both cases sets the state, another one keeps or flips it. So a range begins as the last
    setting one before it ended, flipped as often as flipping ones lie between. A file's window holds a few numbers for
    each of its ranges.
    """
    sets = F.col("outside_to") == F.col("inside_to")
    flips = (F.col("outside_to") & ~F.col("inside_to")).cast("long")
    earlier = Window.partitionBy("path").orderBy("start").rowsBetween(Window.unboundedPreceding, -1)
    last = F.last(F.when(sets, F.col("outside_to")), ignorenulls=True).over(earlier)
    since = F.coalesce(F.sum(sets.cast("long")).over(earlier), F.lit(0))
    known = ends.withColumns({"last": F.coalesce(last, F.lit(False)), "since": since, "flips": flips})
    between = Window.partitionBy("path", "since").orderBy("start").rowsBetween(Window.unboundedPreceding, -1)
    odd = F.coalesce(F.sum("flips").over(between), F.lit(0)) % 2 == 1
    return known.select("path", "start", "stop", (F.col("last") != odd).alias("inside"))


def _spread(ranges: DataFrame) -> DataFrame:
    """One range a task, or some, where ranges are many and small: a task costs more than such a range."""
    found = ranges.agg(F.count(F.lit(1)).alias("n"), F.sum(F.expr("stop - start")).alias("bytes")).first()
    least = TASKS_A_CORE * ranges.sparkSession.sparkContext.defaultParallelism
    return ranges.repartition(max(1, min(found["n"], max(least, -(-(found["bytes"] or 0) // RANGE_BYTES)))))


def splittable(spark: SparkSession, path: str, encoding: str) -> bool:
    """Whether line breaks, quotes and commas are single bytes in ``encoding`` that stand for nothing else, no file is
    packed, and Python workers can open ranges of the files."""
    name = codecs.lookup(encoding).name
    if not (name in ("utf-8", "ascii") or name.startswith(("iso8859", "cp125"))):
        return False
    files = spark.read.format("binaryFile").load(path).select("path")
    one = files.first()
    if one is not None:
        try:
            open_file(one["path"]).close()
        except (pa.ArrowInvalid, pa.ArrowNotImplementedError):  # a file system that only Spark's readers know
            return False
    return files.where(F.lower("path").rlike(_PACKED)).isEmpty()


def csv_records(spark: SparkSession, path: str, encoding: str = "UTF-8", range_bytes: int = RANGE_BYTES) -> DataFrame:
    """(record) for each record of the headed CSV files under ``path``; the first line of a file begins its header.

    Lines end in ``\\n`` or ``\\r\\n``; empty ones between records are left out. Only numbers are kept of a range, one row for
    each, as Spark's own plan of a scan does.
    """
    ship_package(spark)
    ranges = byte_ranges(spark, path, range_bytes)

    def judge(batches):
        for batch in batches:
            rows = batch.to_pylist()
            for row in rows:
                with open_file(row["path"]) as file:
                    row["outside_to"], row["inside_to"] = range_ends(file, row["start"], row["stop"])
            yield pa.RecordBatch.from_pylist(rows, judged)

    def cut(batches):
        for batch in batches:
            for row in batch.to_pylist():
                held, size, header = [], 0, row["start"] == 0
                with open_file(row["path"]) as file:
                    for record in range_records(file, row["start"], row["stop"], row["inside"]):
                        record = record.removesuffix(b"\r")
                        if header or not record:
                            header = header and not record
                            continue
                        held.append(record.decode(encoding, "replace"))
                        size += len(record)
                        if size >= SEND:
                            yield pa.RecordBatch.from_arrays([pa.array(held, pa.string())], ["record"])
                            held, size = [], 0
                if held:
                    yield pa.RecordBatch.from_arrays([pa.array(held, pa.string())], ["record"])

    names = ["path", "start", "stop", "outside_to", "inside_to"]
    judged = pa.schema(list(zip(names, [pa.string(), pa.int64(), pa.int64(), pa.bool_(), pa.bool_()], strict=True)))
    ends = _spread(ranges).mapInArrow(judge, "path string, start long, stop long, outside_to boolean, inside_to boolean")
    begun = stage(_with_beginnings(stage(ends, "csv-ends")), "csv-ranges")
    return _spread(begun).mapInArrow(cut, "record string")


def _inferred(reader: DataFrameReader, path: str, records: DataFrame) -> T.StructType:
    """The schema that Spark infers from the records, under the names of the header."""
    kinds = reader.option("header", False).option("inferSchema", True).csv(records.rdd.map(itemgetter(0))).schema
    names = reader.option("header", True).option("inferSchema", False).csv(path).columns  # reads the first record alone
    known = [field.dataType for field in kinds.fields] + [T.StringType()] * len(names)
    return T.StructType([T.StructField(name, kind) for name, kind in zip(names, known, strict=False)])


def read_quoted_csv(
    spark: SparkSession,
    path: str,
    schema: T.StructType | None = None,
    encoding: str = "UTF-8",
    range_bytes: int = RANGE_BYTES,
) -> DataFrame:
    """CSV files with a header and quoted line breaks as a table; without a ``schema`` it is inferred, from all records.

    Files that cannot be split (see ``splittable``) are read by one task each.
    """
    dialect = {"quote": '"', "escape": '"', "multiLine": True}

    def reader() -> DataFrameReader:
        return spark.read.options(header=True, encoding=encoding, **dialect)

    if not splittable(spark, path, encoding):
        return reader().schema(schema).csv(path) if schema else reader().option("inferSchema", True).csv(path)
    records = csv_records(spark, path, encoding, range_bytes)
    schema = schema or _inferred(reader(), path, records)
    parsed = F.from_csv("record", schema.simpleString(), {k: str(v).lower() for k, v in dialect.items()})
    return records.select(parsed.alias("r")).select(*[F.col("r")[name].alias(name) for name in schema.fieldNames()])
