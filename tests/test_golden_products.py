"""Golden facts of the product slice on the sample source CSVs (FIXTURES.md §4).

Set ``LAYERCAKE_SAMPLES`` to a source folder laid out as ``<source>/<file>``
that holds the sample product and category files; the files are only read.
The test is skipped when the variable is unset.
"""

from __future__ import annotations

import datetime as dt
import os
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from layercake.plans import gold, silver
from layercake.sources import dataset, read_csv_source

SAMPLES = Path(os.environ.get("LAYERCAKE_SAMPLES", "/nonexistent"))
PRD = SAMPLES / "crm" / "prd_info.csv"
CAT = SAMPLES / "erp" / "PX_CAT_G1V2.csv"
needs_samples = pytest.mark.skipif(not (PRD.exists() and CAT.exists()), reason="LAYERCAKE_SAMPLES not set")


@pytest.fixture(scope="module")
def products(spark):
    prd = silver.prd_info(read_csv_source(spark, str(PRD), dataset("crm", "prd_info")))
    cat = silver.px_cat_g1v2(read_csv_source(spark, str(CAT), dataset("erp", "px_cat_g1v2")))
    return prd, gold.dim_products(prd, cat)


def counts(df, col):
    return {r[0]: r[1] for r in df.groupBy(col).count().collect()}


@needs_samples
def test_silver_prd_info_facts(products):
    prd, _ = products
    assert prd.count() == 397
    assert prd.select("prd_key").distinct().count() == 295
    assert counts(prd, "prd_line") == {"Road": 162, "Mountain": 112, "Other Sales": 54, "Touring": 52, "n/a": 17}
    assert prd.agg(F.sum("prd_cost")).first()[0] == 171543
    versions = [
        (r.prd_start_dt, r.prd_end_dt, r.prd_cost)
        for r in prd.where(F.col("prd_key") == "HL-U509-R").orderBy("prd_start_dt").collect()
    ]
    assert versions == [
        (dt.date(2011, 7, 1), dt.date(2012, 6, 30), 12.0),
        (dt.date(2012, 7, 1), dt.date(2013, 6, 30), 14.0),
        (dt.date(2013, 7, 1), None, 13.0),
    ]


@needs_samples
def test_gold_dim_products_facts(products):
    _, dim = products
    assert dim.count() == 295
    assert counts(dim, "product_line") == {"Road": 100, "Mountain": 91, "Touring": 52, "Other Sales": 35, "n/a": 17}
    assert dim.agg(F.sum("cost")).first()[0] == 127165
    assert counts(dim, "category") == {"Components": 127, "Bikes": 97, "Clothing": 35, "Accessories": 29, None: 7}
    assert {r.category_id for r in dim.where(F.col("category").isNull()).collect()} == {"CO_PE"}
    keyed = {r.product_key: (r.product_number, r.product_id) for r in dim.collect()}
    assert sorted(keyed) == list(range(1, 296))
    assert [keyed[k] for k in (1, 2, 3, 295)] == [
        ("FR-R92B-58", 210), ("FR-R92R-58", 211), ("BK-M82B-38", 348), ("WB-H098", 477),
    ]


# The same slice on invented files.

PRODUCTS = """prd_id,prd_key,prd_nm,prd_cost,prd_line,prd_start_dt,prd_end_dt
1,AB-CD-X1,"Lamp, small",10,R ,2011-07-01,
2,AB-CD-X1,"Lamp, small",12,R ,2012-07-01,2007-12-28
3,AB-CD-X1,"Lamp, small",,r,2013/07/01,
4,EF-GH-Y2,Chair,7,S ,2012 07 01,
5,ZZ-ZZ-Q9,Unknown kind,3,,2011-07-01,
"""
CATEGORIES = """ID,CAT,SUBCAT,MAINTENANCE
AB_CD,Lights,Lamps,Yes
EF_GH,Furniture,Chairs,No
"""


@pytest.fixture(scope="module")
def invented(spark, tmp_path_factory):
    folder = tmp_path_factory.mktemp("products")
    (folder / "prd.csv").write_text(PRODUCTS)
    (folder / "cat.csv").write_text(CATEGORIES)
    prd = silver.prd_info(read_csv_source(spark, str(folder / "prd.csv"), dataset("crm", "prd_info")))
    cat = silver.px_cat_g1v2(read_csv_source(spark, str(folder / "cat.csv"), dataset("erp", "px_cat_g1v2")))
    return prd, gold.dim_products(prd, cat)


def test_invented_silver_prd_info(invented):
    prd, _ = invented
    got = [(r.prd_id, r.cat_id, r.prd_key, r.prd_cost, r.prd_line, str(r.prd_start_dt), r.prd_end_dt and str(r.prd_end_dt)) for r in prd.orderBy("prd_id").collect()]
    assert got == [
        (1, "AB_CD", "X1", 10.0, "Road", "2011-07-01", "2012-06-30"),
        (2, "AB_CD", "X1", 12.0, "Road", "2012-07-01", "2013-06-30"),
        (3, "AB_CD", "X1", 0.0, "Road", "2013-07-01", None),
        (4, "EF_GH", "Y2", 7.0, "Other Sales", "2012-07-01", None),
        (5, "ZZ_ZZ", "Q9", 3.0, "n/a", "2011-07-01", None),
    ]


def test_invented_gold_dim_products(invented):
    _, dim = invented
    got = [(r.product_key, r.product_number, r.category, r.maintenance) for r in dim.orderBy("product_key").collect()]
    assert got == [(1, "Q9", None, None), (2, "Y2", "Furniture", "No"), (3, "X1", "Lights", "Yes")]


@pytest.mark.parametrize("start", ["2025", "2025-01", "2025-01-05 xx", "soon"])
def test_a_start_that_is_no_date_fails(spark, start):
    rows = spark.createDataFrame([(1, "AB-CD-X1", "n", 1.0, "R", start, None)], "prd_id long, prd_key string, prd_nm string, prd_cost double, prd_line string, prd_start_dt string, prd_end_dt string")
    with pytest.raises(Exception, match="not a date"):
        silver.prd_info(rows).collect()
