"""Ranges of CSV files with quoted line breaks against Spark's own reader, which takes such a file in one task."""

import random

import pytest
from pyspark.sql import functions as F

from tallyloom.schema import RAW, RAW_COLUMNS
from tallyloom.sources import quoted_csv
from tallyloom.sources.quoted_csv import ends_inside, open_file, range_ends, range_records, read_quoted_csv
from tallyloom.sources.readers import read_transactions_csv

HEADER = ",".join(RAW_COLUMNS) + "\n"
LINES = [
    '1,S,"two\nlines",6,2010-12-01 08:26:00,2.5,17850,France\n',
    "2,S,plain,6,2010-12-01 08:26:00,2.5,17850,France\n",
    '3,S,"a ""b""\n\n""c"", d\n",six,2010-12-01 08:26:00,x,,"Fra\nnce"\n',
    '4,S,5" pipe,6,2010-12-01 08:26:00,2.5,17850,France\n',
    '5,"","""",6,2010-12-01 08:26:00,2.5,17850,\n',
    "\n",
    '6,S,café £,6,"2010-12-01\n08:26:00",2.5,17850, "x" \n',
    '"7\n","\n"," , ""\n,",6,,,,"\n"\n',
]


def as_rows(df):
    return sorted(map(str, df.collect()))


def whole(spark, path, encoding="UTF-8", schema=RAW):
    reader = spark.read.options(header=True, quote='"', escape='"', encoding=encoding, multiLine=True)
    return reader.schema(schema).csv(path) if schema else reader.option("inferSchema", True).csv(path)


@pytest.mark.parametrize("encoding", ["UTF-8", "ISO-8859-1"])
@pytest.mark.parametrize("range_bytes", [1, 7, 60, 1 << 20])
def test_every_range_size_reads_what_one_task_reads(spark, tmp_path, encoding, range_bytes):
    for name, order in (("a", LINES), ("b", LINES[::-1])):
        (tmp_path / f"{name}.csv").write_bytes((HEADER + "".join(order)).encode(encoding))
    (tmp_path / "c.csv").write_bytes((HEADER + LINES[1].strip()).encode(encoding))
    (tmp_path / "d.csv").write_bytes(HEADER.encode())
    (tmp_path / "e.csv").write_bytes(b"")
    found = read_quoted_csv(spark, str(tmp_path), RAW, encoding, range_bytes)
    assert found.schema == RAW
    expected = as_rows(whole(spark, str(tmp_path), encoding))
    assert as_rows(found) == expected and len(expected) == 15


def test_random_files_in_memory(tmp_path, monkeypatch):
    """Records of all ranges together, cut at any places, against a plain state machine over the whole file."""
    random.seed(3)
    monkeypatch.setattr(quoted_csv, "BLOCK", 5)
    for n in range(120):
        text = "".join(random.choices(['"', "\n", ",", "a", '""', ',"', '",', "b\n"], k=random.randint(1, 40)))
        path = tmp_path / f"{n}.csv"
        path.write_text(text, newline="")
        data, records, held, inside = text.encode(), [], b"", False
        for line in data.splitlines(keepends=True):
            held, inside = held + line, ends_inside(line, inside)
            if not inside:
                records.append(held.removesuffix(b"\n"))
                held = b""
        records += [held] if held else []
        cuts = sorted({0, len(data), *(random.randrange(len(data) + 1) for _ in range(random.randint(0, 6)))})
        found, state = [], False
        with open_file(path.as_uri()) as file:
            for start, stop in zip(cuts, cuts[1:], strict=False):
                found += range_records(file, start, stop, state)
                state = range_ends(file, start, stop)[state]
        assert [r.removesuffix(b"\n") for r in found] == [r.removesuffix(b"\n") for r in records], text


def test_states_are_carried_over_kept_flipped_and_set_ranges(spark):
    random.seed(4)
    rows, expected = [], {}
    for path in ("x", "y"):
        state = False
        for start in range(0, 40):
            ends = random.choice([(False, True), (True, False), (False, True), (True, True), (False, False)])
            rows.append((path, start, start + 1, *ends))
            expected[path, start] = state
            state = ends[state]
    random.shuffle(rows)
    ends = spark.createDataFrame(rows, "path string, start long, stop long, outside_to boolean, inside_to boolean")
    found = {(r["path"], r["start"]): r["inside"] for r in quoted_csv._with_beginnings(ends).collect()}
    assert found == expected


def test_windows_line_ends_and_a_record_over_many_ranges(spark, tmp_path):
    long = '9,S,"' + "x\r\n" * 500 + '",6,2010-12-01 08:26:00,2.5,17850,France\r\n'
    text = HEADER.replace("\n", "\r\n") + "1,S,mug,6,2010-12-01 08:26:00,2.5,17850,France\r\n" + long + long.replace("9,S", "8,S")
    (tmp_path / "a.csv").write_bytes(text.encode())
    found = read_quoted_csv(spark, str(tmp_path), RAW, range_bytes=100)
    assert as_rows(found) == as_rows(whole(spark, str(tmp_path)))
    assert found.where("InvoiceNo = '9'").first()["Description"] == "x\r\n" * 500


def test_records_are_read_by_many_tasks(spark, tmp_path):
    text = HEADER + "".join(f'{i},S,"two\nlines, ""{i}""",{i % 9 + 1},2010-12-01 08:26:00,2.5,17850,France\n' for i in range(4000))
    (tmp_path / "a.csv").write_text(text)
    found = read_transactions_csv(spark, str(tmp_path / "a.csv"), multi_line=True, range_bytes=len(text) // 16)
    tasks = found.groupBy(F.spark_partition_id()).count().collect()
    assert len(tasks) >= 16 and sum(r["count"] for r in tasks) == 4000 and max(r["count"] for r in tasks) < 500
    assert as_rows(found) == as_rows(whole(spark, str(tmp_path)))


def test_inferred_schema_and_unsplittable_files(spark, tmp_path):
    import gzip

    text = (HEADER + LINES[0] + '2,7,"x\ny",6,2010-12-02 10:00:00,1,1.5,France\n').encode()
    (tmp_path / "plain").mkdir()
    (tmp_path / "plain" / "a.csv").write_bytes(text)
    found = read_quoted_csv(spark, str(tmp_path / "plain"), range_bytes=50)
    expected = whole(spark, str(tmp_path / "plain"), schema=None)
    assert found.schema == expected.schema and as_rows(found) == as_rows(expected)
    (tmp_path / "packed").mkdir()
    (tmp_path / "packed" / "a.csv.gz").write_bytes(gzip.compress(text))
    assert as_rows(read_quoted_csv(spark, str(tmp_path / "packed"), RAW)) == as_rows(whole(spark, str(tmp_path / "plain")))
    (tmp_path / "wide").mkdir()
    (tmp_path / "wide" / "a.csv").write_bytes(text.decode().encode("utf-16"))
    assert as_rows(read_quoted_csv(spark, str(tmp_path / "wide"), RAW, "UTF-16")) == as_rows(whole(spark, str(tmp_path / "plain")))


def test_small_ranges_read_little_more_than_their_bytes(tmp_path):
    line = '1,S,"two\nlines",6,2010-12-01 08:26:00,2.5,17850,France\n'
    (tmp_path / "a.csv").write_text(HEADER + line * 40_000)

    class Counted:
        def __init__(self, file):
            self.file, self.read = file, 0

        def size(self):
            return self.file.size()

        def read_at(self, count, place):
            data = self.file.read_at(count, place)
            self.read += len(data)
            return data

    with open_file((tmp_path / "a.csv").as_uri()) as plain:
        size, records = plain.size(), 0
        for work in (range_ends, range_records):
            file, state = Counted(plain), False
            for start in range(0, size, 1 << 18):
                if work is range_records:
                    records += sum(1 for _ in range_records(file, start, min(size, start + (1 << 18)), state))
                state = range_ends(file if work is range_ends else plain, start, min(size, start + (1 << 18)))[state]
            assert file.read <= 1.3 * size, (work, file.read, size)
    assert records == 40_001


def test_many_small_ranges_share_tasks(spark):
    """One range a task up to some tasks for each core; then tasks grow with the bytes, not with the number of ranges."""
    cores = spark.sparkContext.defaultParallelism
    rows = spark.range(cores * 100).selectExpr("'x' as path", "id * 1000 as start", "id * 1000 + 1000 as stop")
    assert quoted_csv._spread(rows).rdd.getNumPartitions() == 4 * cores
    assert quoted_csv._spread(rows.limit(3)).rdd.getNumPartitions() == 3 and quoted_csv._spread(rows.limit(0)).rdd.getNumPartitions() == 1
    large = rows.selectExpr("path", f"start div 1000 * {64 << 20} as start", f"(start div 1000 + 1) * {64 << 20} as stop")
    assert quoted_csv._spread(large).rdd.getNumPartitions() == cores * 100
