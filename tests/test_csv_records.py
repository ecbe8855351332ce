"""CSV records in parallel splits."""

from __future__ import annotations

import csv
import io
import random

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from layercake.plans import runner
from layercake.sources import DatasetSpec, TypeDriftError, check_types, read_csv_source, type_drift
from layercake.sources.csv_records import csv_records, ends_inside, field_count
from tests.test_datasets import CSV

SPEC = DatasetSpec("t", "notes", "notes.csv", T.StructType([T.StructField(c, T.StringType()) for c in ("id", "note", "tail")]))


@pytest.fixture
def small_splits(spark):
    keys = {"spark.sql.files.maxPartitionBytes": None, "spark.sql.files.openCostInBytes": "1", "spark.sql.files.minPartitionNum": "1"}
    old = {k: spark.conf.get(k, None) for k in keys}
    for k, v in keys.items():
        if v:
            spark.conf.set(k, v)
    yield lambda size: spark.conf.set("spark.sql.files.maxPartitionBytes", str(size))
    for k, v in old.items():
        spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def inside_by_character(text, inside):
    """The state after a text, one character at a time."""
    state = "quoted" if inside else "begin"
    for ch in text:
        if state == "quoted":
            state = "closing" if ch == '"' else "quoted"
        elif state == "closing":
            state = "quoted" if ch == '"' else "begin" if ch == "," else "plain"
        elif ch == ",":
            state = "begin"
        elif state == "begin":
            state = "quoted" if ch == '"' else "plain"
    return state == "quoted"


def test_line_states_by_character():
    r = random.Random(1)
    for _ in range(5000):
        text = "".join(r.choice('ab,," "\r') for _ in range(r.randrange(0, 14)))
        for inside in (False, True):
            assert ends_inside(text.encode(), inside) == inside_by_character(text, inside), (text, inside)


def notes(r, n):
    """Rows with newlines, quotes, commas and stray quotes inside values."""
    words = ["plain", "a,b", 'say "hi"', "two\nlines", "\n\n", "é中", "", "x" * 50, "\r\nwindows\r\n", '"', ",", "NA"]
    return [(str(i), " ".join(r.choice(words) for _ in range(r.randrange(0, 6))), r.choice(words)) for i in range(n)]


def as_csv(rows, r, end="\n"):
    out = io.StringIO()
    out.write("id,note,tail" + end)
    for row in rows:
        if r.random() < 0.1:
            out.write(f'{row[0]},5" pipe and 6" pipe,it\'s 7"{end}')  # stray quotes
        else:
            csv.writer(out, lineterminator=end, quoting=r.choice([csv.QUOTE_MINIMAL, csv.QUOTE_ALL])).writerow(row)
    return out.getvalue()


def one_split(spark, path):
    """The same file by Spark's reader, which takes it as one split."""
    options = {"quote": '"', "escape": '"', "multiLine": True, "header": True, "ignoreLeadingWhiteSpace": False, "ignoreTrailingWhiteSpace": False}
    return spark.read.options(**options).schema("id string, note string, tail string").csv(path)


@pytest.mark.parametrize(("size", "end"), [(60, "\n"), (1000, "\n"), (700, "\r\n")])
def test_splits_equal_one_split(spark, tmp_path, small_splits, size, end):
    r = random.Random(size)
    path = tmp_path / "a b%20é" / "notes.csv"
    path.parent.mkdir()
    path.write_bytes(as_csv(notes(r, 50 if size < 100 else 300), r, end).encode())
    small_splits(size)
    got = sorted(map(tuple, read_csv_source(spark, str(path), SPEC).collect()), key=lambda x: int(x[0]))
    # Spark's reader rewrites newlines inside the values of files with \r\n: those by Python's
    want = map(tuple, one_split(spark, str(path)).collect()) if end == "\n" else list(csv.reader(io.StringIO(path.read_bytes().decode(), newline="")))[1:]
    assert got == [tuple(None if v in (None, "", "NA") else v for v in row) for row in want]


def test_a_large_file_reads_in_ten_splits(spark, tmp_path, small_splits):
    r = random.Random(2)
    path = tmp_path / "notes.csv"
    block = as_csv(notes(r, 4000), r).split("\n", 1)
    text = block[0] + "\n" + block[1] * (20_000_000 // len(block[1]))
    path.write_text(text, newline="")
    small_splits(2 << 20)
    got = read_csv_source(spark, str(path), SPEC)
    assert got.select(F.count("*"), F.sum(F.xxhash64("id", "note", "tail").cast("decimal(38,0)"))).first() == one_split(spark, str(path)).select(
        F.count("*"), F.sum(F.xxhash64("id", *[F.when(F.col(c).isin("", "NA"), F.lit(None)).otherwise(F.col(c)) for c in ("note", "tail")]).cast("decimal(38,0)"))
    ).first()
    lines = spark.read.option("lineSep", "\n").text(str(path))
    assert lines.rdd.getNumPartitions() >= 10


def test_the_text_is_scanned_once(spark, tmp_path):
    """The returned plan reads the marked lines, not the file."""
    path = tmp_path / "notes.csv"
    path.write_text('id,note,tail\n1,"a\nb",c\n')
    df = read_csv_source(spark, str(path), SPEC)
    path.unlink()
    assert [tuple(x) for x in df.collect()] == [("1", "a\nb", "c")]


def test_hidden_folders_are_not_read(spark, tmp_path):
    folder = tmp_path / "_in" / "notes"  # a hidden part above the given folder is the caller's
    for name in ("a.csv", "_temporary/0/part.csv", "sub/.staging/part.csv", "sub/b.csv", "_SUCCESS"):
        file = folder / name
        file.parent.mkdir(parents=True, exist_ok=True)
        file.write_text(f"id,note,tail\n{name},x,y\n")
    assert sorted(x["id"] for x in read_csv_source(spark, str(folder), SPEC).collect()) == ["a.csv", "sub/b.csv"]


def test_a_long_record_names_dataset_file_and_line(spark, tmp_path, small_splits):
    path = tmp_path / "notes.csv"
    path.write_text("id,note,tail\n" + '1,"two\nlines",x\n' * 40 + '2,"a\nb",c,\n' + "3,x,y\n" * 40)
    small_splits(100)
    with pytest.raises(Exception, match=r"t\.notes: more fields than the 3 columns.*notes\.csv line 82: 2,"):
        read_csv_source(spark, str(path), SPEC).collect()


def test_an_unclosed_value_names_the_file(spark, tmp_path):
    path = tmp_path / "notes.csv"
    path.write_text('id,note,tail\n1,"a,b\n2,c,d\n')
    with pytest.raises(ValueError, match=r"t\.notes: .*notes\.csv"):
        read_csv_source(spark, str(path), SPEC)


def test_header_only_and_blank_lines(spark, tmp_path):
    (tmp_path / "a.csv").write_text("id,note,tail")
    (tmp_path / "b.csv").write_text("id,note,tail\n\n1,x\n   \n\n")
    assert [tuple(x) for x in read_csv_source(spark, str(tmp_path), SPEC).collect()] == [("1", "x", None)]
    assert csv_records(spark, [str(tmp_path / "a.csv")], "t").count() == 0


def test_field_count(spark):
    values = ["", "a", "a,b", ",", '"a,b",c', '"a""b,",c,', '5" x,y', '"a"b,c', '"a\nb",c']
    df = spark.createDataFrame([(v, len(next(csv.reader(io.StringIO(v)), [""]))) for v in values], "v string, n int")
    assert df.where(field_count(F.col("v")) != F.col("n")).collect() == []


def test_type_drift_names_column_value_and_place(spark, tmp_path):
    spec = DatasetSpec("t", "sizes", "sizes.csv", T.StructType([T.StructField("id", T.LongType()), T.StructField("price", T.DoubleType()), T.StructField("note", T.StringType()), T.StructField("gone", T.LongType())]))
    path = tmp_path / "sizes.csv"
    path.write_text('id,price,note,gone\n1,2.5,"a\nb",\nNA,1e3,7,NA\n3.0,5,x,\n" 4 ",NaN,,null\n5.5,7f,,\n99999999999999999999,x,,\n')
    got = {r["column"]: tuple(r)[1:] for r in type_drift(spark, str(path), spec).collect()}
    file = got["id"][5]
    assert file.endswith("sizes.csv")
    assert got == {
        "id": ("LONG", "DOUBLE", 5, 3, "3.0", file, 5),
        "price": ("DOUBLE", "TEXT", 5, 2, "7f", file, 7),
        "note": ("TEXT", "TEXT", 3, 0, None, None, None),
        "gone": ("LONG", "NONE", 0, 0, None, None, None),
    }
    with pytest.raises(TypeDriftError, match=r"t\.sizes: id is LONG but 3 of 5 values need DOUBLE, first '3\.0' in .*sizes\.csv line 5; price"):
        check_types(spark, str(path), spec)
    path.write_text("id,price,note,gone\n1,2,a,\n")
    check_types(spark, str(path), spec)
    path.write_text("id,price,note,gone\n")
    assert [r["needed"] for r in type_drift(spark, str(path), spec).collect()] == ["NONE"] * 4


def test_a_run_names_the_drifted_column(spark, tmp_path):
    source = tmp_path / "src"
    for (system, name), text in CSV.items():
        (source / system).mkdir(parents=True, exist_ok=True)
        (source / system / name).write_text(text)
    sales = source / "crm" / "sales_details.csv"
    sales.write_text(sales.read_text().replace("20110105", "2011-01-05", 1))
    with pytest.raises(TypeDriftError, match=r"crm\.sales_details: sls_ship_dt is LONG.*'2011-01-05' in .* line 2"):
        runner.run_bronze(spark, str(tmp_path / "lake"), str(source), "2026-09-18")
