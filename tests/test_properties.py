"""Property tests: the sliced operators equal plain windows on random data
(hot keys, NULL keys and starts, ties and fully identical rows)."""

from __future__ import annotations

import datetime as dt

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import Window
from pyspark.sql import functions as F

from layercake.operators import Sort, dense_key, validity_end

KEYS = st.one_of(st.none(), st.sampled_from(["hot", "hot", "hot", "a", "b", "c"]))
DAYS = st.one_of(st.none(), st.integers(min_value=0, max_value=20))
ROWS = st.lists(st.tuples(KEYS, DAYS, st.integers(min_value=0, max_value=5)), min_size=1, max_size=120)
SETTINGS = settings(max_examples=6, deadline=None, suppress_health_check=list(HealthCheck))


def frame(spark, rows):
    base = dt.date(2020, 1, 1)
    data = [(k, None if d is None else base + dt.timedelta(days=d), v) for k, d, v in rows]
    return spark.createDataFrame(data, "k string, d date, v int")


@SETTINGS
@given(rows=ROWS, per_slice=st.integers(min_value=3, max_value=40))
def test_validity_end_equals_window(spark, rows, per_slice):
    df = frame(spark, rows)
    got = validity_end(df, "k", "d", "end", tiebreak=["v"], slices=per_slice)
    w = Window.partitionBy("k").orderBy(F.col("d").asc_nulls_last(), F.col("v").asc_nulls_last())
    want = df.withColumn("end", F.date_sub(F.lead("d").over(w), 1))
    assert sorted(got.collect(), key=repr) == sorted(want.collect(), key=repr)


@SETTINGS
@given(rows=ROWS, per_slice=st.integers(min_value=3, max_value=40))
def test_dense_key_equals_row_number(spark, rows, per_slice):
    df = frame(spark, rows)
    got = dense_key(df, ["d", "k"], "sk", slices=per_slice)
    order = [s.column() for s in (Sort("d"), Sort("k"), Sort("v"))]
    want = df.withColumn("sk", F.row_number().over(Window.orderBy(*order)).cast("bigint"))
    assert sorted(got.collect(), key=repr) == sorted(want.collect(), key=repr)
