"""Frame operators against brute-force Spark windows, plus plan checks."""

from __future__ import annotations

import datetime as dt
import itertools
import random
from decimal import Decimal

import pytest
from pyspark.errors import AnalysisException
from pyspark.sql import Window
from pyspark.sql import functions as F

from layercake.operators import (
    Sort,
    asc,
    asof_left,
    check_rules,
    current_only,
    dense_key,
    desc,
    duplicate_keys,
    enrich_left,
    keep_latest,
    validity_end,
)


def plan_text(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def skewed_versions(spark, n=2000, seed=7):
    """A third of the rows on one key, NULL keys and NULL / tied starts."""
    rnd = random.Random(seed)
    data = []
    for i in range(n):
        k = "hot" if i % 3 == 0 else rnd.choice([None, "a", "b", "c", "d"])
        d = None if rnd.random() < 0.05 else dt.date(2020, 1, 1) + dt.timedelta(days=rnd.randint(0, 40))
        data.append((i, k, d))
    return spark.createDataFrame(data, "id long, k string, d date")


def test_op3_keep_latest_matches_window_and_plans_partial_limit(spark):
    df = skewed_versions(spark)
    got = keep_latest(df, ["k"], [desc("d")], tiebreak=[desc("id")])
    w = Window.partitionBy("k").orderBy(F.col("d").desc_nulls_last(), F.col("id").desc_nulls_last())
    want = df.withColumn("rn", F.row_number().over(w)).where("rn = 1").drop("rn")
    assert sorted(got.collect()) == sorted(want.collect())
    final = plan_text(got)  # after collect: the final adaptive plan
    assert final.count("WindowGroupLimit") >= 2  # partial (map side, before the shuffle) + final


def brute_validity(df):
    w = Window.partitionBy("k").orderBy(F.col("d").asc_nulls_last(), F.col("id").asc_nulls_last())
    return df.withColumn("end", F.date_sub(F.lead("d").over(w), 1))


def test_op4_validity_end_local_path(spark):
    df = skewed_versions(spark)
    got = validity_end(df, "k", "d", "end", tiebreak=["id"])
    assert sorted(got.collect()) == sorted(brute_validity(df).collect())


def test_op4_validity_end_sliced_path_splits_hot_key(spark):
    df = skewed_versions(spark)
    got = validity_end(df, "k", "d", "end", tiebreak=["id"], slices=20)
    assert sorted(got.collect()) == sorted(brute_validity(df).collect())


def test_op5_current_only(spark):
    df = spark.createDataFrame([(1, None), (2, dt.date(2020, 1, 1))], "id int, e date")
    assert [r.id for r in current_only(df, "e").collect()] == [1]


def brute_key(df, sorts):
    return df.withColumn("sk", F.row_number().over(Window.orderBy(*[s.column() for s in sorts])).cast("bigint"))


def test_op14_dense_key_local_and_sliced(spark):
    df = skewed_versions(spark)
    sorts = [Sort("d"), Sort("k"), Sort("id")]
    want = sorted(brute_key(df, sorts).collect())
    assert sorted(dense_key(df, ["d", "k"], "sk").collect()) == want
    sliced = dense_key(df, ["d", "k"], "sk", slices=14)
    assert sorted(sliced.collect()) == want
    assert sliced.schema["sk"].dataType.simpleString() == "bigint"


def test_op14_sliced_plan_has_no_single_partition_exchange(spark):
    df = skewed_versions(spark)
    for slices in (None, 1, 14):
        keyed = dense_key(df, ["d"], "sk", slices=slices)
        assert sorted(r.sk for r in keyed.collect()) == list(range(1, 2001))
        assert "SinglePartition" not in keyed._jdf.queryExecution().executedPlan().toString()
    assert dense_key(df.where("false"), ["d"], "sk").collect() == []
    assert validity_end(df.where("false"), "k", "d", "end").collect() == []


def test_op15_enrich_left_semantics(spark):
    left = spark.createDataFrame([(1, "a"), (2, "b"), (3, None)], "id int, k string").alias("l")
    right = spark.createDataFrame([("a", 10), ("a", 11), ("c", 30), (None, 99)], "k string, v int").alias("r")
    out = enrich_left(left, right, F.col("l.k") == F.col("r.k")).select("l.id", "r.v")
    assert sorted(out.collect(), key=lambda r: (r[0], r[1] or 0)) == [(1, 10), (1, 11), (2, None), (3, None)]


def skewed_fact(spark, n=30_000):
    """A third of the references on one customer, another third NULL."""
    cust = F.when(F.col("id") % 3 == 0, F.lit(7)).when(F.col("id") % 3 == 1, F.lit(None)).otherwise(F.col("id") % 500)
    return spark.range(n).select(F.col("id").alias("line"), cust.cast("bigint").alias("cust"), F.concat(F.lit("C"), cust.cast("string")).alias("name"))


@pytest.mark.parametrize("broadcast", [True, False, "auto"])
def test_op15_null_and_composite_keys(spark, broadcast):
    """Key lists give the plain left join, whatever its plan."""
    fact = skewed_fact(spark, 3000).alias("f")
    dim = spark.range(400).select(F.col("id").cast("int").alias("cid"), F.concat(F.lit("C"), F.col("id").cast("string")).alias("name"), (F.col("id") + 100).alias("ckey"))
    dim = dim.unionAll(spark.createDataFrame([(None, None, 1), (7, "C7", 2), (7, None, 3)], "cid int, name string, ckey long")).alias("d")
    f, d = [F.col("f.cust"), F.col("f.name")], [F.col("d.cid"), F.col("d.name")]
    for k in (1, 2):
        cond = (f[0] == d[0]) if k == 1 else (f[0] == d[0]) & (f[1] == d[1])
        want = fact.join(dim, cond, "left").select("f.line", "d.ckey").collect()
        got = enrich_left(fact, dim, left_on=f[:k], right_on=d[:k], broadcast=broadcast)
        assert got.columns == [*fact.columns, *dim.columns]
        assert sorted(got.select("f.line", "d.ckey").collect(), key=repr) == sorted(want, key=repr)


KEY_TYPES = {
    "string": ["05", "5", " 5", "x", "5.0", None],
    "int": [5, 7, None],
    "long": [5, 2**40, None],
    "double": [5.0, 0.5, float("nan"), -0.0, 0.0, None],
    "decimal(10,2)": [5, 7, None],
    "date": [dt.date(2020, 1, 5), None],
}


@pytest.mark.parametrize("pair", list(itertools.product(KEY_TYPES, KEY_TYPES)), ids="-".join)
def test_op15_key_lists_equal_a_plain_join(spark, pair):
    """Same rows as a plain left join for every pair of types that a join compares."""
    frames = []
    for name, kind in zip("lr", pair, strict=True):
        values = [(i, None if v is None else Decimal(v) if kind.startswith("decimal") else v) for i, v in enumerate(KEY_TYPES[kind] * 2)]
        frames.append(spark.createDataFrame(values, f"{name}id int, {name}k {kind}").alias(name))
    left, right = frames
    spark.conf.set("spark.sql.ansi.enabled", "false")  # texts that are no numbers compare as null
    try:
        plain = left.join(right, F.col("l.lk") == F.col("r.rk"), "left")
        plain.schema  # noqa: B018 - analysed here
    except AnalysisException:
        spark.conf.set("spark.sql.ansi.enabled", "true")
        with pytest.raises(AnalysisException):
            enrich_left(left, right, left_on=[F.col("l.lk")], right_on=[F.col("r.rk")]).schema
        return
    try:
        want = sorted(tuple(r) for r in plain.select(F.col("lid"), F.coalesce("rid", F.lit(-1))).collect())
        got = enrich_left(left, right, left_on=[F.col("l.lk")], right_on=[F.col("r.rk")])
        assert sorted(tuple(r) for r in got.select(F.col("lid"), F.coalesce("rid", F.lit(-1))).collect()) == want
    finally:
        spark.conf.set("spark.sql.ansi.enabled", "true")


@pytest.mark.parametrize("slices", [1, 7, 30])
def test_asof_left_equals_an_asof_join(spark, slices):
    """Hot and NULL keys, NULL times, ties, rows before the first version, a key over many
    slices of which only the first has a version."""
    import duckdb

    rnd = random.Random(slices)
    day = lambda: None if rnd.random() < 0.05 else dt.date(2020, 1, 1) + dt.timedelta(days=rnd.randint(0, 60))
    lines = [(i, "hot" if i % 3 == 0 else "once" if i % 3 == 1 else rnd.choice([None, "a", "b", "none"]), day()) for i in range(1500)]
    versions = [(100 + i, rnd.choice(["hot", "hot", "a", "b", "unused", None]), day()) for i in range(60)] + [(99, "once", dt.date(2020, 1, 3))]
    left = spark.createDataFrame(lines, "id int, k string, d date")
    right = spark.createDataFrame(versions, "v int, k string, d date")
    got = asof_left(left, right, left_on="k", right_on="k", left_time="d", right_time="d", columns={"version": "v", "since": "d"}, tiebreak=["v"], slices=slices)
    assert got.columns == ["id", "k", "d", "version", "since"]
    con = duckdb.connect()
    con.register("l", left.toPandas())
    con.register("r", right.toPandas())
    want = con.execute(
        "SELECT l.id, w.v::INT, w.since::DATE FROM l ASOF LEFT JOIN (SELECT k, d AS since, max(v) AS v FROM r WHERE d IS NOT NULL GROUP BY ALL) AS w ON l.k = w.k AND w.since <= l.d"
    ).fetchall()
    assert sorted(map(tuple, got.select("id", "version", "since").collect()), key=repr) == sorted(want, key=repr)


def test_asof_left_without_rows(spark):
    left = spark.createDataFrame([(1, "a", dt.date(2020, 1, 1))], "id int, k string, d date")
    how = {"left_on": "k", "right_on": "k", "left_time": "d", "right_time": "d", "columns": {"version": "id"}}
    assert [tuple(r) for r in asof_left(left, left.where("false"), **how).collect()] == [(1, "a", dt.date(2020, 1, 1), None)]
    assert asof_left(left.where("false"), left, **how).collect() == []
    with pytest.raises(ValueError, match="do not compare"):
        asof_left(left, left.withColumn("k", F.lit(1)), **how)


def test_op15_columns_without_a_hash(spark):
    left = spark.createDataFrame([(1, "a", {"x": 1}, [{"y": 2}]), (2, None, {}, [])], "id int, k string, m map<string,int>, n array<map<string,int>>")
    right = spark.createDataFrame([("a", 10)], "rk string, v int")
    got = enrich_left(left, right, left_on=[F.col("k")], right_on=[F.col("rk")], broadcast=False)
    assert sorted((r["id"], r["m"], r["v"]) for r in got.collect()) == [(1, {"x": 1}, 10), (2, {}, None)]


def test_op15_broadcast_is_sparks_choice(spark, tmp_path):
    """Without a word from the caller, the size of a side's files decides."""
    left = spark.range(100).withColumnRenamed("id", "k")
    spark.range(50).withColumnRenamed("id", "k").write.parquet(str(tmp_path / "small"))
    right = spark.read.parquet(str(tmp_path / "small"))
    for broadcast, expected in (("auto", True), (True, True), (False, False)):
        joined = enrich_left(left, right, "k", broadcast=broadcast)
        assert ("BroadcastHashJoin" in joined._jdf.queryExecution().sparkPlan().toString()) is expected
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "10")
    try:
        joined = enrich_left(left, right, "k")
        assert "BroadcastHashJoin" not in joined._jdf.queryExecution().sparkPlan().toString()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


def test_op16_check_rules_counts_false_and_null(spark):
    df = spark.createDataFrame([(1, 2), (None, 2), (3, 3), (5, 2)], "a int, b int")
    out = {r.rule: (r.violations, r.unknown, r.checked) for r in
           check_rules(df, {"a_le_b": F.col("a") <= F.col("b"), "b_pos": F.col("b") > 0}).collect()}
    assert out == {"a_le_b": (1, 1, 4), "b_pos": (0, 0, 4)}


def test_duplicate_keys(spark):
    df = spark.createDataFrame([("a",), ("a",), ("b",)], "k string")
    assert [(r.k, r.copies) for r in duplicate_keys(df, ["k"]).collect()] == [("a", 2)]


def test_scratch_scope_removes_its_tables(spark, tmp_path):
    from pathlib import Path

    from layercake.session import scratch_scope

    df = skewed_versions(spark, n=600)
    with scratch_scope(spark) as created:
        keyed = dense_key(df, ["d"], "sk", slices=20)
        out = str(tmp_path / "out")
        keyed.write.parquet(out)
        assert len(created) == 1  # the range slices
    assert all(not Path(p.removeprefix("file:")).exists() for p in created)
    assert spark.read.parquet(out).count() == 600


def test_range_slices_split_a_group_of_copies(spark):
    """A third of the rows are identical: the slices stay balanced and the
    distributed results equal the plain windows."""
    from layercake.operators.ordering import SLICE, range_slices

    copies = spark.range(3000).select(
        F.when(F.col("id") % 3 == 0, F.lit(1)).otherwise(F.col("id")).alias("k"),
        F.when(F.col("id") % 3 == 0, F.lit("2020-01-01")).otherwise(F.lit("2020-02-01")).cast("date").alias("d"),
    )
    sliced = range_slices(copies, [Sort("k"), Sort("d")], 10, "test-copies")
    sizes = [r["count"] for r in sliced.groupBy(SLICE).count().collect()]
    assert sum(sizes) == 3000 and max(sizes) < 3 * 3000 / 10
    want_key = sorted(brute_key(copies, [Sort("k"), Sort("d")]).collect())
    assert sorted(dense_key(copies, ["k", "d"], "sk", slices=10).collect()) == want_key
    w = Window.partitionBy("k").orderBy(F.col("d").asc_nulls_last())
    want_end = copies.withColumn("end", F.date_sub(F.lead("d").over(w), 1))
    got_end = validity_end(copies, "k", "d", "end", slices=10)
    assert sorted(got_end.collect()) == sorted(want_end.collect())


def test_sort_helpers():
    assert asc("x") == Sort("x") and desc("x").descending and not desc("x").nulls_first


def test_op15_chained_joins_split_hot_and_null_keys(spark, tmp_path):
    """Two merge joins on one key, as in the customer dimension: no task writes more
    than twice the mean, with a third of the rows on one key and a third without one."""
    conf = {
        "spark.sql.shuffle.partitions": "8",
        "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "2k",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1.2",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "40k",
        "spark.sql.adaptive.coalescePartitions.enabled": "false",
    }
    old = {k: spark.conf.get(k, None) for k in conf}
    try:
        for k, v in conf.items():
            spark.conf.set(k, v)
        n = 30_000
        fact = skewed_fact(spark, n).alias("f")
        dim = spark.range(500).select(F.col("id").alias("cid"), (F.col("id") + 1000).alias("ckey"))
        key = [F.col("f.cust")]
        once = enrich_left(fact, dim.alias("d"), left_on=key, right_on=[F.col("d.cid")], broadcast=False)
        twice = enrich_left(once, dim.alias("e"), left_on=key, right_on=[F.col("e.cid")], broadcast=False)
        result = twice.select("f.line", F.col("d.ckey").alias("a"), F.col("e.ckey").alias("b"), F.spark_partition_id().alias("task"))
        result.write.parquet(str(tmp_path / "out"))
        rows = spark.read.parquet(str(tmp_path / "out"))
        assert rows.count() == n and rows.where("a IS NULL").count() == n // 3 and rows.where("NOT a <=> b").count() == 0
        sizes = [r["count"] for r in rows.groupBy("task").count().collect()]
        assert max(sizes) <= 2 * n / len(sizes), sizes
    finally:
        for k, v in old.items():
            if v is None:
                spark.conf.unset(k)
            else:
                spark.conf.set(k, v)


def test_slices_follow_the_volume(spark, tmp_path):
    from layercake.operators.ordering import LEAST_SLICE_BYTES, SLICE_BYTES_SETTING, input_bytes, slice_count, slices_for

    assert slices_for(40 * 2**40, 64 << 20, 8, 200) == 40 * 2**20 // 64
    assert slices_for(4000 * (64 << 20) - 5, 64 << 20, 1000, 200) == 4000
    assert [slices_for(v, 64 << 20, 8, 200) for v in (0, 10, 3 * LEAST_SLICE_BYTES, 100 * LEAST_SLICE_BYTES, None)] == [1, 1, 3, 8, 200]
    df = spark.range(200_000).select("id", F.sha2(F.col("id").cast("string"), 256).alias("text"))
    assert input_bytes(df) is None and slice_count(df) == int(spark.conf.get("spark.sql.shuffle.partitions"))
    df.write.parquet(str(tmp_path / "t"))
    table = spark.read.parquet(str(tmp_path / "t"))
    size = input_bytes(table)
    files = sum(f.stat().st_size for f in (tmp_path / "t").glob("*.parquet"))
    assert files <= size <= 4 * files and input_bytes(table.unionByName(table)) == 2 * size
    assert input_bytes(table.groupBy("id").count().join(table, "id")) == 2 * size
    assert slice_count(table, 7) == 7
    try:
        spark.conf.set(SLICE_BYTES_SETTING, str(size // 4000))
        assert 4000 <= slice_count(table.where("id > 3")) <= 4002
    finally:
        spark.conf.unset(SLICE_BYTES_SETTING)
    assert slice_count(spark.read.parquet(str(tmp_path / "t")).where("id < 0").limit(0)) >= 1


@pytest.mark.parametrize("slices", [40, 1000])
def test_slices_are_even(spark, slices):
    """A third of the rows on one sort key, a third identical: rows per slice stay within
    twice the mean, at few and at many slices."""
    from layercake.operators.ordering import SLICE, as_sorts, complete_tiebreak, range_slices

    n = 100_000
    kind = F.col("id") % 3
    df = spark.range(n, numPartitions=8).select(
        F.when(kind == 0, F.lit(5)).when(kind == 1, F.lit(7)).otherwise(F.hash("id")).alias("k"),
        F.when(kind == 1, F.lit("same")).otherwise(F.col("id").cast("string")).alias("v"),
    )
    staged = range_slices(df, complete_tiebreak(df, as_sorts(["k"])), slices, "even")
    sizes = [r["count"] for r in staged.groupBy(SLICE).count().collect()]
    assert sum(sizes) == n and max(sizes) <= 2 * n / slices
