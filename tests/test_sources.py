"""CSV ingest, layer layout, partition overwrite, dates."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from layercake.sources import (
    DatasetSpec,
    dataset,
    layer_path,
    read_csv_source,
    read_layer,
    resolve_partition_date,
    write_layer,
)

SPEC = DatasetSpec(
    "t", "people", "people.csv",
    T.StructType([
        T.StructField("id", T.DoubleType()),
        T.StructField("name", T.StringType()),
        T.StructField("amount", T.LongType()),
    ]),
)


def write(tmp_path, text, name="people.csv"):
    p = tmp_path / name
    p.write_text(text)
    return str(p)


def test_src1_csv_na_tokens_quotes_case_and_padding(spark, tmp_path):
    path = write(tmp_path, 'ID,Name,AMOUNT\n1,"q""q",10\n2,NA,\n,n/a,NULL\n4, NA ,7\n5,"a,b"\n6,#N/A,8')
    df = read_csv_source(spark, path, SPEC)
    got = sorted((r[0] if r[0] is not None else -1, r[1], r[2]) for r in df.collect())
    assert got == [(-1, None, None), (1.0, 'q"q', 10), (2.0, None, None), (4.0, " NA ", 7),
                   (5.0, "a,b", None), (6.0, None, 8)]
    assert [f.dataType for f in df.schema.fields] == [T.DoubleType(), T.StringType(), T.LongType()]


def test_src1_long_row_fails(spark, tmp_path):
    path = write(tmp_path, "id,name,amount\n1,a,2,extra\n")
    with pytest.raises(Exception, match="(?i)column"):
        read_csv_source(spark, path, SPEC).collect()


@pytest.mark.parametrize("row", ["1,a,2,extra", "1,x,,EXTRA", "1,x,,,EXTRA", "1,,,EXTRA", '1,"x,y",,"E"'])
def test_src1_long_row_with_blank_cells_fails_for_any_column(spark, tmp_path, row):
    path = write(tmp_path, f"id,name,amount\n1,b,2\n{row}\n")
    for cols in (["id"], ["name"], ["amount"], ["id", "name", "amount"]):
        with pytest.raises(Exception, match="(?i)column"):
            read_csv_source(spark, path, SPEC).select(*cols).collect()


def test_src1_blank_last_cell_is_no_long_row(spark, tmp_path):
    path = write(tmp_path, 'id,name,amount\n1,x,\n2,"a,b",\n3,,\n')
    assert [tuple(r) for r in read_csv_source(spark, path, SPEC).orderBy("id").collect()] == [(1, "x", None), (2, "a,b", None), (3, None, None)]


@pytest.mark.parametrize("multi_line", [None, True])
def test_src1_quoted_newlines(spark, tmp_path, multi_line):
    path = write(tmp_path, 'id,name,amount\n1,"New\nZealand",5\n2,"say ""hi""\n",6\n3,plain,7\n')
    rows = read_csv_source(spark, path, SPEC, multi_line=multi_line).orderBy("id").collect()
    assert [tuple(r) for r in rows] == [(1, "New\nZealand", 5), (2, 'say "hi"\n', 6), (3, "plain", 7)]


def test_src1_files_with_other_column_orders(spark, tmp_path):
    folder = tmp_path / "people"
    folder.mkdir()
    write(folder, "id,name,amount\n1,a,10\n", "a.csv")
    write(folder, "ID,AMOUNT,NAME\n2,20,b\n", "b.csv")
    write(folder, "", "c.csv")
    df = read_csv_source(spark, str(folder), SPEC)
    assert df.columns == ["id", "name", "amount"]
    assert [tuple(r) for r in df.orderBy("id").collect()] == [(1, "a", 10), (2, "b", 20)]
    write(folder, "id,name\n3,c\n", "d.csv")
    with pytest.raises(ValueError, match="amount"):
        read_csv_source(spark, str(folder), SPEC)


def test_src1_compressed_file(spark, tmp_path):
    import gzip

    path = tmp_path / "people.csv.gz"
    path.write_bytes(gzip.compress("id,name,amount\n1,é,10\n".encode()))
    assert [tuple(r) for r in read_csv_source(spark, str(path), SPEC).collect()] == [(1, "é", 10)]


def test_src5_missing_csv_names_the_dataset(spark, tmp_path):
    with pytest.raises(FileNotFoundError, match="t.people"):
        read_csv_source(spark, str(tmp_path / "none.csv"), SPEC)


def test_snk_empty_days(spark, tmp_path):
    base = str(tmp_path / "lake")
    df = spark.range(5).withColumn("v", F.lit("a"))
    nothing = df.where("id < 0")
    assert write_layer(nothing, base, "gold", "things", "2026-01-01") == 0
    first = read_layer(spark, base, "gold", "things", "2026-01-01")
    assert first.columns == ["id", "v"] and first.collect() == []
    assert write_layer(df, base, "gold", "things", "2026-01-02") == 5
    assert write_layer(df, base, "gold", "things", "2026-01-03") == 5
    assert write_layer(nothing, base, "gold", "things", "2026-01-02") == 0
    counts = [read_layer(spark, base, "gold", "things", f"2026-01-0{d}").count() for d in (1, 2, 3)]
    assert counts == [0, 0, 5]


def test_scratch_needs_a_shared_folder_on_a_cluster(monkeypatch):
    from types import SimpleNamespace

    from layercake.session import checkpoint_dir

    for master in ("spark://host:7077", "yarn", "local-cluster[2,1,1024]"):
        context = SimpleNamespace(master=master, getCheckpointDir=lambda: None)
        with pytest.raises(ValueError, match="spark.checkpoint.dir"):
            checkpoint_dir(SimpleNamespace(sparkContext=context, conf=SimpleNamespace(get=lambda *_: None)))


def test_src1_missing_column_is_reported(spark, tmp_path):
    path = write(tmp_path, "id,name\n1,a\n")
    with pytest.raises(ValueError, match="amount"):
        read_csv_source(spark, path, SPEC)


def test_snk_layout_dynamic_overwrite_and_counts(spark, tmp_path):
    base = str(tmp_path / "lake")
    df = spark.range(5).withColumn("v", F.lit("a"))
    assert write_layer(df, base, "silver", "things", "2026-01-01", "crm") == 5
    assert write_layer(df.limit(3), base, "silver", "things", "2026-01-02", "crm") == 3
    assert write_layer(df.limit(2).withColumn("v", F.lit("b")), base, "silver", "things", "2026-01-02", "crm") == 2
    day1 = read_layer(spark, base, "silver", "things", "2026-01-01", "crm")
    day2 = read_layer(spark, base, "silver", "things", "2026-01-02", "crm")
    assert day1.count() == 5 and sorted(r.v for r in day2.collect()) == ["b", "b"]
    assert "ingest_date" not in day1.columns
    assert layer_path(base, "gold", "fact") == f"{base}/gold/fact"


def test_src5_missing_input_raises_file_not_found(spark, tmp_path):
    with pytest.raises(FileNotFoundError, match="bronze"):
        read_layer(spark, str(tmp_path), "bronze", "nope", "2026-01-01", "crm")


def test_snk9_partition_date(monkeypatch):
    assert resolve_partition_date("2026-09-18") == "2026-09-18"
    monkeypatch.setenv("PARTITION_DATE", "2026-01-02")
    assert resolve_partition_date() == "2026-01-02"
    monkeypatch.delenv("PARTITION_DATE")
    assert len(resolve_partition_date()) == 10
    with pytest.raises(ValueError):
        resolve_partition_date("18/09/2026")


def test_src4_catalog_lookup():
    assert dataset("erp", "px_cat_g1v2").source_file == "PX_CAT_G1V2.csv"
    with pytest.raises(ValueError):
        dataset("crm", "nope")


def test_snk8_base_and_store_settings(monkeypatch):
    from layercake.sources import object_store_conf_from_env, resolve_base

    monkeypatch.delenv("MINIO_BUCKET", raising=False)
    monkeypatch.delenv("MINIO_ENDPOINT", raising=False)
    assert resolve_base() == "data" and resolve_base("/lake") == "/lake"
    assert object_store_conf_from_env() == {}
    monkeypatch.setenv("MINIO_BUCKET", "lake")
    monkeypatch.setenv("MINIO_ENDPOINT", "http://store:9000")
    monkeypatch.setenv("MINIO_ACCESS_KEY", "k")
    monkeypatch.setenv("MINIO_SECRET_KEY", "s")
    assert resolve_base() == "s3a://lake"
    conf = object_store_conf_from_env()
    assert conf["spark.hadoop.fs.s3a.endpoint"] == "http://store:9000"
    assert conf["spark.hadoop.fs.s3a.path.style.access"] == "true"
    assert conf["spark.hadoop.fs.s3a.connection.ssl.enabled"] == "false"
