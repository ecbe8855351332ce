"""Driver contract: entry() and every query against its SQL oracle (sf0.001)."""

from __future__ import annotations

import decimal
import datetime as dt
from collections import Counter
from pathlib import Path

import duckdb
import pytest

import __spark_entry__ as entry
from layercake.plans.driver_queries import QUERIES

SF = "/root/testdata/sf0.001"
TABLES = "region nation customer supplier part orders lineitem events".split()
pytestmark = pytest.mark.skipif(not Path(SF).exists(), reason="driver tables not present")


def norm(v):
    if isinstance(v, (float, decimal.Decimal)):
        return round(float(v), 6)
    if isinstance(v, (dt.date, dt.datetime)):
        return v.isoformat()
    return v


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    return con


def test_entry_smoke(spark):
    df = entry.entry(spark)
    assert df.count() > 0
    assert df.columns == ["order_number", "product_key", "customer_key", "order_date", "shipping_date",
                          "due_date", "sales_amount", "quantity", "price"]


def test_every_query_has_an_oracle():
    assert set(QUERIES) <= set(entry.oracle_sql()) <= set(entry.queries())


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_oracle(spark, duck, name):
    df = entry.queries()[name](spark, SF)
    cols = sorted(df.columns)
    got = Counter(tuple(norm(r[c]) for c in cols) for r in df.collect())
    res = duck.execute(entry.oracle_sql()[name])
    names = [d[0] for d in res.description]
    assert sorted(names) == cols
    idx = [names.index(c) for c in cols]
    want = Counter(tuple(norm(row[i]) for i in idx) for row in res.fetchall())
    assert got == want


@pytest.mark.parametrize("name", ["gold_fact_sales", "silver_cust_info", "title_case_names", "rule_violations"])
def test_plans_stay_in_the_jvm(spark, name):
    """No Python UDF evaluation in the plans."""
    df = entry.queries()[name](spark, SF)
    df.collect()
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "BatchEvalPython" not in plan and "ArrowEvalPython" not in plan


def test_gold_plans_have_no_single_partition_window(spark):
    for name in ("gold_dim_customers", "gold_dim_products", "gold_fact_sales"):
        plan = entry.queries()[name](spark, SF)._jdf.queryExecution().sparkPlan().toString()
        assert "SinglePartition" not in plan and "Window" not in plan


def test_fanout_reads_lineitem_once(spark):
    """The silver sales are written once and then joined and counted."""
    plan = entry.queries()["fact_fanout"](spark, SF)._jdf.queryExecution().sparkPlan().toString()
    assert "lineitem.parquet" not in plan and "orders.parquet" not in plan


def test_fact_scan_prunes_columns(spark):
    df = entry.queries()["silver_sales_details"](spark, SF)
    plan = df._jdf.queryExecution().sparkPlan().toString()
    lineitem_scan = [line for line in plan.split("\n") if "lineitem.parquet" in line][0]
    assert "l_discount" not in lineitem_scan and "l_returnflag" not in lineitem_scan


def test_sales_lines_run_compiled(spark):
    """The JVM compiles no method of more than 8000 bytes; a session with Spark's own settings
    runs such methods interpreted, at a tenth of the speed."""
    settings = {"spark.sql.adaptive.enabled": "false", "spark.sql.codegen.hugeMethodLimit": "65535"}
    before = {k: spark.conf.get(k) for k in settings}
    try:
        for k, v in settings.items():
            spark.conf.set(k, v)
        plan = entry.queries()["silver_sales_details"](spark, SF)._jdf.queryExecution().executedPlan()
        stages = spark._jvm.org.apache.spark.sql.execution.debug.package.codegenStringSeq(plan)
        sizes = [stages.apply(i)._3().maxMethodCodeSize() for i in range(stages.size())]
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)
    assert sizes and max(sizes) <= 8000


def test_queries_without_the_optional_part():
    """A library that only the training-data operators need is missing: the rest works."""
    import subprocess
    import sys

    code = (
        "import sys; sys.modules['public_tokenizers'] = None\n"
        "import __spark_entry__ as e\n"
        "from layercake.plans.driver_queries import QUERIES\n"
        "assert set(e.queries()) == set(e.oracle_sql()) == set(QUERIES)"
    )
    done = subprocess.run([sys.executable, "-c", code], cwd=Path(entry.__file__).parent, capture_output=True, text=True)
    assert done.returncode == 0, done.stderr
