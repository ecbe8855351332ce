"""Silver / gold datasets on hand-made fixtures, and the pipeline runner."""

from __future__ import annotations

import datetime as dt
import time

import pytest

from layercake.plans import gold, runner, silver
from layercake.sources import SOURCE_CATALOG

D = dt.date


def test_ds_s1_cust_info(spark):
    bronze = spark.createDataFrame(
        [
            (1.0, "AW1", "  joHN ", "SMITH", "S", "M", "2020-01-01"),
            (1.0, "AW1", "old", "name", "M", "F", "2019-01-01"),
            (2.0, "AW2", "", None, "s", None, None),
            (None, "AW9", "x", "y", "S", "M", "2020-01-01"),
            (2.5, "AW3", "\t", "ok", "X", "F", "2025-01"),
        ],
        "cst_id double, cst_key string, cst_firstname string, cst_lastname string, "
        "cst_marital_status string, cst_gndr string, cst_create_date string",
    )
    out = {r.cst_id: r for r in silver.cust_info(bronze).collect()}
    assert set(out) == {1, 2}  # NULL id dropped, 2.5 rounds half-even to 2
    assert len(silver.cust_info(bronze).columns) == 8
    john = out[1]
    assert (john.cst_firstname, john.cst_lastname, john.cst_marital_status, john.cst_gndr) == (
        "John", "Smith", "Single", "Male")
    assert john.cst_create_date == D(2020, 1, 1) and john.dq_missing_name_flag is False
    # id 2 keeps the record with a date (NULLs last) -- here the 2.5 row (date invalid -> NULL)
    # ties on NULL date with the other id-2 row; the tie-break orders by cst_key.
    two = out[2]
    assert two.cst_key == "AW2" and two.cst_firstname == "n/a" and two.cst_lastname == "n/a"
    assert two.cst_marital_status == "Unknown" and two.cst_gndr == "Unknown" and two.dq_missing_name_flag


def product_bronze(spark):
    rows = [
        (210, "CO-RF-FR-R92B-58", "Frame", None, "R ", "2003-07-01"),
        (300, "AC-HE-HL-U509-R", "Helmet", 12.0, "S ", "2011-07-01"),
        (301, "AC-HE-HL-U509-R", "Helmet", 14.0, "S ", "2012-07-01"),
        (302, "AC-HE-HL-U509-R", "Helmet", 13.0, "S ", "2013-07-01"),
        (400, "CO-PE-PD-M282", "Pedal", 20.0, None, "2013-07-01"),
    ]
    return spark.createDataFrame(
        [(*r, "2000-01-01") for r in rows],
        "prd_id long, prd_key string, prd_nm string, prd_cost double, prd_line string, "
        "prd_start_dt string, prd_end_dt string",
    )


def test_ds_s2_prd_info_versions(spark):
    out = {r.prd_id: r for r in silver.prd_info(product_bronze(spark)).collect()}
    assert [(out[i].prd_start_dt, out[i].prd_end_dt, out[i].prd_cost) for i in (300, 301, 302)] == [
        (D(2011, 7, 1), D(2012, 6, 30), 12.0), (D(2012, 7, 1), D(2013, 6, 30), 14.0), (D(2013, 7, 1), None, 13.0),
    ]
    assert out[210].prd_cost == 0.0 and out[210].prd_line == "Road" and out[210].cat_id == "CO_RF"
    assert out[400].prd_line == "n/a" and out[300].prd_line == "Other Sales"


def test_ds_g2_dim_products_current_and_keys(spark):
    px = spark.createDataFrame(
        [("CO_RF", "Components", "Road Frames", "Yes"), ("AC_HE", "Accessories", "Helmets", "No"),
         ("CO_PD", "Components", "Pedals", "No")],
        "ID string, CAT string, SUBCAT string, MAINTENANCE string",
    )
    dim = gold.dim_products(silver.prd_info(product_bronze(spark)), px).orderBy("product_key").collect()
    assert [(r.product_key, r.product_id) for r in dim] == [(1, 210), (2, 302), (3, 400)]
    assert dim[2].category is None  # CO_PE has no lookup row
    assert dim[0].category == "Components" and len(dim[0]) == 11


def test_ds_s3_sales_details(spark):
    bronze = spark.createDataFrame(
        [("SO1", "BK-1", 1, 20101229, 0, 201013, 10, 2, 5), ("SO2", "BK-2", 2, None, 20100229, 20240229, None, 2, None)],
        "sls_ord_num string, sls_prd_key string, sls_cust_id long, sls_order_dt long, sls_ship_dt long, "
        "sls_due_dt long, sls_sales long, sls_quantity long, sls_price long",
    )
    out = sorted(silver.sales_details(bronze).collect())
    assert (out[0].sls_order_dt, out[0].sls_ship_dt, out[0].sls_due_dt) == (D(2010, 12, 29), None, None)
    assert out[1].sls_due_dt == D(2024, 2, 29) and out[1].sls_sales is None and out[1].sls_price is None
    assert len(out[0]) == 9


def test_ds_s4_s5_erp(spark):
    az = spark.createDataFrame(
        [("NASAW1", "1980-05-05", "FEMALE "), ("nasAW2", "2030-01-01", " m"), ("AW3", "2020-01-01", "X")],
        "cid string, bdate string, gen string",
    )
    out = sorted(silver.cust_az12(az, "2020-01-01").collect())
    assert out == [("AW1", D(1980, 5, 5), "Female"), ("AW3", D(2020, 1, 1), "n/a"), ("nasAW2", None, "Male")]
    loc = spark.createDataFrame([("AW-0-1", "USA "), ("AW-2", None), ("AW3", " France ")], "cid string, cntry string")
    assert sorted(silver.loc_a101(loc).collect()) == [("AW01", "United States"), ("AW2", "n/a"), ("AW3", "France")]


CSV = {
    ("crm", "cust_info.csv"): "cst_id,cst_key,cst_firstname,cst_lastname,cst_marital_status,cst_gndr,cst_create_date\n"
    "11000,AW00011000, Jon,Yang ,M,M,2025-10-06\n11001,AW00011001,Eugene,Huang,S,,2025-10-06\n"
    "11001,AW00011001,Old,Name,S,F,2020-01-01\n,AW00099999,No,Id,S,M,2025-10-06\n",
    ("crm", "prd_info.csv"): "prd_id,prd_key,prd_nm,prd_cost,prd_line,prd_start_dt,prd_end_dt\n"
    "210,CO-RF-FR-R92B-58,HL Road Frame,,R ,2003-07-01,\n"
    "211,AC-HE-HL-U509-R,Sport-100 Helmet,12,S ,2011-07-01,2007-12-28\n"
    "212,AC-HE-HL-U509-R,Sport-100 Helmet,14,S ,2012-07-01,\n",
    ("crm", "sales_details.csv"): "sls_ord_num,sls_prd_key,sls_cust_id,sls_order_dt,sls_ship_dt,sls_due_dt,"
    "sls_sales,sls_quantity,sls_price\nSO43697,HL-U509-R,11000,20101229,20110105,20110110,3578,1,3578\n"
    "SO43698,FR-R92B-58,11001,0,20110105,20110110,,2,10\nSO43699,ZZ-404,99999,20101229,20110105,20110110,5,1,\n",
    ("erp", "PX_CAT_G1V2.csv"): "ID,CAT,SUBCAT,MAINTENANCE\nAC_HE,Accessories,Helmets,Yes\nCO_RF,Components,Road Frames,Yes",
    ("erp", "CUST_AZ12.csv"): "CID,BDATE,GEN\nNASAW00011000,1971-10-06,Male\nAW00011001,2099-01-01,Female\n",
    ("erp", "LOC_A101.csv"): "CID,CNTRY\nAW-00011000,AUSTRALIA\nAW-00011001,US\n",
}


def test_pipeline_end_to_end(spark, tmp_path):
    src = tmp_path / "source"
    for (source, name), text in CSV.items():
        (src / source).mkdir(parents=True, exist_ok=True)
        (src / source / name).write_text(text)
    base = str(tmp_path / "lake")
    results = runner.run_all(spark, base, str(src), "2026-09-18")
    counts = {(r.layer, r.dataset): r.rows for r in results}
    assert counts[("bronze", "crm.cust_info")] == 4
    assert counts[("silver", "crm.cust_info")] == 2
    assert counts[("gold", "dim_customers")] == 2
    assert counts[("gold", "dim_products")] == 2
    assert counts[("gold", "fact_sales")] == 3
    # re-run is idempotent
    again = runner.run_gold(spark, base, "2026-09-18")
    assert [r.rows for r in again] == [2, 2, 3]
    from layercake.sources import read_layer

    fact = {r.order_number: r for r in read_layer(spark, base, "gold", "fact_sales", "2026-09-18").collect()}
    assert fact["SO43697"].product_key == 2 and fact["SO43697"].customer_key == 1
    assert fact["SO43698"].sales_amount == 20 and fact["SO43698"].order_date is None
    assert fact["SO43699"].product_key is None and fact["SO43699"].customer_key is None
    dims = {r.customer_id: r for r in read_layer(spark, base, "gold", "dim_customers", "2026-09-18").collect()}
    assert dims[11000].country == "AUSTRALIA" and dims[11000].birthdate == D(1971, 10, 6)
    assert dims[11001].gender == "Unknown"  # literal fallback only replaces 'n/a' (kept on purpose)
    assert dims[11001].birthdate is None  # after the business date
    m = runner.metrics_frame(spark, results)
    assert m.count() == len(results)


def test_pl5_unknown_dataset(spark, tmp_path):
    with pytest.raises(ValueError, match="unknown silver dataset"):
        runner.transform_dataset(spark, str(tmp_path), "crm.nope", "2026-01-01")


def test_catalog_has_six_sources():
    assert sum(len(v) for v in SOURCE_CATALOG.values()) == 6


def test_pipeline_on_driver_tables_matches_query(spark, tmp_path):
    """CSV export of the stand-ins -> run_all (concurrent steps) publishes the same
    fact as the in-plan ``gold_fact_sales`` query."""
    from pathlib import Path

    from layercake.plans.driver_queries import gold_fact_sales
    from layercake.plans.standins import export_sources, table_reader
    from layercake.sources import read_layer

    sf = "/root/testdata/sf0.001"
    if not Path(sf).exists():
        pytest.skip("driver tables not present")
    source = export_sources(table_reader(spark, sf), str(tmp_path / "source"))
    base = str(tmp_path / "lake")
    runner.run_all(spark, base, source, "2026-09-18", parallelism=3)
    published = read_layer(spark, base, "gold", "fact_sales", "2026-09-18")
    from collections import Counter

    assert Counter(published.collect()) == Counter(gold_fact_sales(spark, sf).collect())


def test_repaired_sales_satisfy_the_invariant(spark):
    """The reference's own check: after the repair no line violates
    sales = quantity * |price| when the defects are in sales or in a non-zero price."""
    from pyspark.sql import functions as F

    from layercake.plans.quality import check_sales

    base = spark.range(1, 5001).select(
        F.concat(F.lit("SO"), F.col("id").cast("string")).alias("sls_ord_num"),
        F.lit("P1").alias("sls_prd_key"),
        F.col("id").alias("sls_cust_id"),
        F.lit(20110105).cast("bigint").alias("sls_order_dt"),
        F.lit(20110112).cast("bigint").alias("sls_ship_dt"),
        F.lit(20110117).cast("bigint").alias("sls_due_dt"),
        (F.col("id") % 7 + 1).alias("q"),
        (F.col("id") % 90 + 10).alias("p"),
    )
    m = F.col("sls_cust_id") % 5
    bronze = base.select(
        "sls_ord_num", "sls_prd_key", "sls_cust_id", "sls_order_dt", "sls_ship_dt", "sls_due_dt",
        F.when(m == 0, F.lit(None)).when(m == 1, -F.col("q") * F.col("p")).when(m == 2, F.lit(0))
        .when(m == 3, F.col("q") * F.col("p") + 3).otherwise(F.col("q") * F.col("p")).cast("bigint").alias("sls_sales"),
        F.col("q").alias("sls_quantity"),
        F.when(m == 4, -F.col("p")).otherwise(F.col("p")).cast("bigint").alias("sls_price"),
    )
    out = silver.sales_details(bronze)
    assert out.count() == 5000
    rules = {r.rule: r for r in check_sales(out).collect()}
    assert rules["sales_equals_quantity_times_price"].violations == 0
    assert rules["sales_equals_quantity_times_price"].unknown == 0


@pytest.mark.parametrize("parallelism", [1, 2])
def test_no_step_starts_after_a_failure(parallelism):
    started = []

    def step(name, fails=False):
        def work():
            started.append(name)
            time.sleep(0.05)
            if fails:
                raise RuntimeError("broken")
            time.sleep(0.2)
            return 1

        return name, work

    steps = [step("first", True), *[step(str(i)) for i in range(6)]]
    with pytest.raises(RuntimeError, match="broken"):
        runner._run_steps("silver", steps, parallelism)
    assert len(started) == parallelism  # what was under way, nothing later
    results = runner._run_steps("silver", steps[1:], parallelism)
    assert [r.dataset for r in results] == [str(i) for i in range(6)]


def test_metrics_table(spark, tmp_path):
    path = str(tmp_path / "metrics")
    for day in ("2026-01-01", "2026-01-02"):
        runner.write_metrics(spark, [runner.StepResult("gold", "fact_sales", 5, 1.5)], path, day)
    rows = spark.read.parquet(path).orderBy("date").collect()
    assert [(r.layer, r.dataset, r.rows, r.seconds, r.date) for r in rows] == [("gold", "fact_sales", 5, 1.5, d) for d in ("2026-01-01", "2026-01-02")]


def test_sales_stand_in_without_quantity(spark):
    """Lines whose amount and price are left out need no quantity; the others fail without."""
    from pyspark.errors import PySparkException

    from layercake.plans.standins import bronze_sales_details

    day = "timestamp_ntz '2020-05-06 00:00:00'"
    line = f"CAST({{}} AS bigint) AS l_orderkey, 5L AS l_partkey, {{}} AS l_linenumber, 0D AS l_quantity, 9D AS l_extendedprice, {day} AS l_shipdate"
    orders = spark.sql(f"SELECT id AS o_orderkey, 7L AS o_custkey, {day} AS o_orderdate FROM range(9)")

    def sales(order, number):
        tables = {"lineitem": spark.sql("SELECT " + line.format(order, number)), "orders": orders}
        return [(r.sls_sales, r.sls_quantity, r.sls_price, r.sls_ship_dt) for r in bronze_sales_details(tables.__getitem__).collect()]

    assert sales(0, 6) == [(None, 0, None, 20200506)]
    with pytest.raises(PySparkException, match="DIVIDE_BY_ZERO"):
        sales(0, 5)
