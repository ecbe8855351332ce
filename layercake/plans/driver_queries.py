"""Every operator and dataset of the engine, run over the driver's tables.

Each function takes ``(spark, sf_dir)`` and returns a lazy DataFrame over whole
tables (some operators run small sizing jobs first: counts, bounded samples).
``oracle.py`` holds the equivalent SQL for each one, under the same name.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from layercake.functions import (
    fallback,
    lenient_date,
    map_codes,
    missing_flag,
    null_if_future,
    parse_int_date,
    repair_amount,
    round_to_long,
    split_composite_key,
    strip_chars,
    strip_prefix,
    title_case,
    trim_spaces,
)
from layercake.operators import current_only, dense_key, desc, keep_latest, validity_end
from layercake.plans import gold, quality, runner, silver
from layercake.plans.gold import GENDER_UNKNOWN_INTENDED
from layercake.session import scratch_dir, write_scratch
from layercake.sources import DatasetSpec, Gate, QualityGateError, layer_path, publish_layer, read_csv_source, read_layer, type_drift, write_layer
from layercake.sources.layers import partition_path
from layercake.plans.standins import (
    STANDIN_AS_OF,
    Tables,
    case_of as _case,
    int_date,
    bronze_cust_az12,
    bronze_cust_info,
    bronze_loc_a101,
    bronze_prd_info,
    bronze_px_cat_g1v2,
    bronze_sales_details,
    export_sources,
    table_reader,
)

Query = Callable[[SparkSession, str], DataFrame]

# Fixed values of the operator demonstrations (code tables and dates).
ORDER_STATUS = {"F": "Fulfilled", "O": "Open", "P": "Partial"}
EVENT_CLASS = {"CLICK": "Engagement", "VIEW": "Engagement", "PURCHASE": "Conversion", "SIGNUP": "Conversion"}
FUTURE_AS_OF = "1998-01-01"
# Many more slices than tasks, as on a large table.
DEMO_SLICES = 40


# ------------------------------------------------------------- column functions


def title_case_names(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = table_reader(spark, sf_dir)("part")
    name = F.col("p_name")
    raw = _case(
        F.col("p_partkey") % 8,
        [
            (0, F.concat(F.lit("  "), F.upper(name), F.lit(" "))),
            (1, F.replace(name, F.lit(" "), F.lit("   "))),
            (2, ""),
            (3, None),
            (4, "   "),
            (5, F.concat(name, F.lit("\tEND"))),
            (6, F.concat(F.lit("mIxEd ΝΙΚΟΣ ßeta éTÉ ñU "), name)),
        ],
        name,
    )
    return p.select("p_partkey", raw.alias("p_name_raw")).select(
        "p_partkey", "p_name_raw", title_case("p_name_raw").alias("p_name_title")
    )


def map_codes_status(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = table_reader(spark, sf_dir)("orders")
    k = F.col("o_orderkey")
    raw = F.when(k % 11 == 0, F.lit(None).cast("string")).when(k % 13 == 0, F.lit("X")).otherwise(F.col("o_orderstatus"))
    return o.select("o_orderkey", raw.alias("o_orderstatus_raw")).select(
        "o_orderkey", "o_orderstatus_raw", map_codes("o_orderstatus_raw", ORDER_STATUS, "Unknown").alias("order_status")
    )


def map_codes_normalized(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = table_reader(spark, sf_dir)("events")
    et = F.col("event_type")
    raw = _case(
        F.col("event_id") % 6,
        [
            (0, F.upper(et)),
            (1, F.concat(F.lit("  "), et, F.lit(" "))),
            (2, None),
            (3, F.upper(F.concat(F.lit(" "), et))),
        ],
        et,
    )
    return e.select("event_id", raw.alias("event_type_raw")).select(
        "event_id",
        "event_type_raw",
        map_codes("event_type_raw", EVENT_CLASS, "n/a", normalize="upper_trim").alias("event_class"),
    )


def country_names(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = table_reader(spark, sf_dir)("customer")
    raw = _case(
        F.col("c_custkey") % 9,
        [(0, "DE"), (1, " US"), (2, "USA "), (3, ""), (4, None), (5, "   "), (6, " France "), (7, "de")],
        F.col("c_mktsegment"),
    )
    return c.select(
        "c_custkey",
        raw.alias("cntry_raw"),
        map_codes(raw, silver.COUNTRY, trim_spaces(raw), normalize="trim", null_as="n/a").alias("country"),
    )


def split_key(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = table_reader(spark, sf_dir)("part")
    k = F.col("p_partkey")
    raw = (
        F.when(k % 13 == 0, F.lit("AB"))
        .when(k % 17 == 0, F.lit(None).cast("string"))
        .otherwise(
            F.concat(
                F.upper(F.substring("p_type", 1, 2)),
                F.lit("-"),
                F.lpad(F.substr("p_brand", F.lit(7)), 2, "0"),
                F.lit("-"),
                F.col("p_name"),
            )
        )
    )
    cat_id, prd_key = split_composite_key(raw, 5, "-", "_")
    return p.select("p_partkey", raw.alias("raw_key"), cat_id.alias("cat_id"), prd_key.alias("prd_key"))


def parse_int_dates(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = table_reader(spark, sf_dir)("orders")
    k = F.col("o_orderkey")
    d = int_date(F.col("o_orderdate"))
    m = k % 10
    raw = (
        F.when(m == 0, F.lit(0).cast("bigint"))
        .when(m == 1, F.floor(d / 1000).cast("bigint"))
        .when(m == 2, d + 1200)
        .when(m == 3, F.lit(None).cast("bigint"))
        .when(m == 4, -F.floor(d / 10).cast("bigint"))
        .when(m == 5, F.lit(20230229).cast("bigint"))
        .when(m == 6, d * 10)
        .when(m == 7, F.lit(20240229).cast("bigint"))
        .otherwise(d)
    )
    return o.select("o_orderkey", raw.alias("int_date")).select(
        "o_orderkey", "int_date", parse_int_date("int_date").alias("parsed_date")
    )


def repair_sales(spark: SparkSession, sf_dir: str) -> DataFrame:
    li = table_reader(spark, sf_dir)("lineitem")
    ok, ln = F.col("l_orderkey"), F.col("l_linenumber")
    q = F.col("l_quantity").cast("bigint")
    p = F.floor(F.col("l_extendedprice") / F.col("l_quantity")).cast("bigint")
    s = q * p
    m = (ok * 7 + ln) % 14
    null = F.lit(None).cast("bigint")
    zero = F.lit(0).cast("bigint")
    raw_s = F.when(m.isin(1, 6, 12), null).when(m == 2, zero).when(m.isin(3, 13), -s).when(m == 4, s + 1).otherwise(s)
    raw_q = F.when(m.isin(9, 10), zero).when(m == 11, null).otherwise(q)
    raw_p = F.when(m.isin(5, 6, 10, 13), null).when(m == 7, zero).when(m.isin(8, 12), -p).otherwise(p)
    staged = li.select("l_orderkey", "l_linenumber", raw_s.alias("raw_sales"), raw_q.alias("sls_quantity"), raw_p.alias("raw_price"))
    sales, price = repair_amount("raw_sales", "sls_quantity", "raw_price")
    return staged.select(
        "l_orderkey", "l_linenumber", "raw_sales", "sls_quantity", "raw_price",
        sales.alias("sls_sales"), price.alias("sls_price"),
    )


def strip_prefix_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = table_reader(spark, sf_dir)("customer")
    name = F.col("c_name")
    raw = _case(
        F.col("c_custkey") % 4,
        [(0, F.concat(F.lit("NAS"), name)), (1, F.concat(F.lit("nas"), name)), (2, "NAS")],
        name,
    )
    return c.select("c_custkey", raw.alias("cid_raw")).select(
        "c_custkey", "cid_raw", strip_prefix("cid_raw", "NAS").alias("cid")
    )


def _date_strings(k: Column, d: Column) -> Column:
    iso = F.date_format(d, "yyyy-MM-dd")
    return _case(
        k % 10,
        [
            (0, iso),
            (1, F.replace(iso, F.lit("-"), F.lit("/"))),
            (2, "garbage"),
            (3, None),
            (4, F.substring(iso, 1, 7)),
            (5, F.concat(iso, F.lit(" 10:30:00"))),
            (6, F.concat(iso, F.lit("T08:15"))),
            (7, F.concat(F.lit(" "), iso)),
            (8, F.date_format(d, "yyyy-M-d")),
        ],
        F.replace(iso, F.lit("-"), F.lit(" ")),
    )


def try_cast_dates(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = table_reader(spark, sf_dir)("orders")
    raw = _date_strings(F.col("o_orderkey"), F.col("o_orderdate"))
    return o.select("o_orderkey", raw.alias("date_raw")).select(
        "o_orderkey", "date_raw", lenient_date("date_raw").alias("parsed_date")
    )


def null_future_dates(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = table_reader(spark, sf_dir)("orders")
    raw = _date_strings(F.col("o_orderkey"), F.col("o_orderdate"))
    return o.select("o_orderkey", raw.alias("bdate_raw")).select(
        "o_orderkey", "bdate_raw", null_if_future("bdate_raw", FUTURE_AS_OF).alias("bdate")
    )


def strip_dashes(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = table_reader(spark, sf_dir)("orders")
    return o.select("o_orderkey", "o_orderpriority", strip_chars("o_orderpriority", "-").alias("priority_code"))


def missing_flag_names(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = table_reader(spark, sf_dir)("customer")
    k = F.col("c_custkey")
    first_raw = _case(k % 5, [(0, ""), (1, None)], F.col("c_name"))
    last_raw = _case(k % 7, [(0, "  ")], F.col("c_mktsegment"))
    cleaned = c.select("c_custkey", title_case(first_raw).alias("first"), title_case(last_raw).alias("last"))
    return cleaned.select(
        "c_custkey",
        F.coalesce("first", F.lit("n/a")).alias("first_name"),
        F.coalesce("last", F.lit("n/a")).alias("last_name"),
        missing_flag("first", "last").alias("dq_missing_name_flag"),
    )


def _genders(c: DataFrame) -> DataFrame:
    k = F.col("c_custkey")
    crm = _case(k % 6, [(0, "Male"), (1, "Female"), (2, "n/a"), (3, "Unknown"), (4, None)], "Female")
    erp = _case(k % 4, [(0, None), (1, "Male"), (2, "Female")], "n/a")
    return c.select("c_custkey", crm.alias("crm_gender"), erp.alias("erp_gender"))


def gender_fallback(spark: SparkSession, sf_dir: str) -> DataFrame:
    g = _genders(table_reader(spark, sf_dir)("customer"))
    return g.select("*", fallback("crm_gender", "erp_gender").alias("gender"))


def gender_fallback_intended(spark: SparkSession, sf_dir: str) -> DataFrame:
    g = _genders(table_reader(spark, sf_dir)("customer"))
    return g.select("*", fallback("crm_gender", "erp_gender", unknown=GENDER_UNKNOWN_INTENDED).alias("gender"))


def pass_through(spark: SparkSession, sf_dir: str) -> DataFrame:
    return silver.px_cat_g1v2(table_reader(spark, sf_dir)("region"))


def cast_rounding(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = table_reader(spark, sf_dir)("events")
    half = F.floor(F.col("value") * 4) / 2
    amount = F.when(F.col("event_id") % 2 == 0, F.lit(0.0) - half).otherwise(half)  # 0 - x: no -0.0
    return e.select("event_id", amount.alias("amount")).select(
        "event_id", "amount", round_to_long("amount").alias("amount_long")
    )


# --------------------------------------------------------------- frame operators


def _orders_dated(t: Tables, null_every: int) -> DataFrame:
    k = F.col("o_orderkey")
    d = F.when(k % null_every == 0, F.lit(None).cast("date")).otherwise(F.to_date("o_orderdate"))
    return t("orders").select("o_orderkey", "o_custkey", "o_totalprice", d.alias("order_date"))


def keep_latest_order(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = _orders_dated(table_reader(spark, sf_dir), 10)
    return keep_latest(o, ["o_custkey"], [desc("order_date")], tiebreak=[desc("o_orderkey")])


def _validity(spark: SparkSession, sf_dir: str, **opts: int | None) -> DataFrame:
    o = _orders_dated(table_reader(spark, sf_dir), 17).select(
        "o_orderkey", "o_custkey", F.col("order_date").alias("valid_from")
    )
    return validity_end(o, "o_custkey", "valid_from", "valid_to", tiebreak=["o_orderkey"], **opts)


def validity_end_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _validity(spark, sf_dir)


def validity_end_distributed(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _validity(spark, sf_dir, slices=DEMO_SLICES)


def current_versions(spark: SparkSession, sf_dir: str) -> DataFrame:
    return current_only(_validity(spark, sf_dir), "valid_to")


def dense_key_distributed(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = table_reader(spark, sf_dir)("orders").select(
        "o_orderkey", "o_custkey", F.to_date("o_orderdate").alias("order_date")
    )
    return dense_key(o, ["order_date", "o_custkey"], "order_sk", slices=DEMO_SLICES)


# ------------------------------------------------------------- silver and gold


SILVER_STANDINS: dict[str, Callable[[Tables], DataFrame]] = {
    "crm.cust_info": lambda t: silver.cust_info(bronze_cust_info(t)),
    "crm.prd_info": lambda t: silver.prd_info(bronze_prd_info(t)),
    "crm.sales_details": lambda t: silver.sales_details(bronze_sales_details(t)),
    "erp.cust_az12": lambda t: silver.cust_az12(bronze_cust_az12(t), STANDIN_AS_OF),
    "erp.loc_a101": lambda t: silver.loc_a101(bronze_loc_a101(t)),
    "erp.px_cat_g1v2": lambda t: silver.px_cat_g1v2(bronze_px_cat_g1v2(t)),
}


class _Silver:
    """Silver stand-in frames, built on first use (some run sizing jobs)."""

    def __init__(self, spark: SparkSession, sf_dir: str) -> None:
        self._tables = table_reader(spark, sf_dir)
        self._built: dict[str, DataFrame] = {}

    def __getitem__(self, name: str) -> DataFrame:
        if name not in self._built:
            self._built[name] = SILVER_STANDINS[name](self._tables)
        return self._built[name]


def _silver_frames(spark: SparkSession, sf_dir: str) -> _Silver:
    return _Silver(spark, sf_dir)


def silver_cust_info(spark: SparkSession, sf_dir: str) -> DataFrame:
    return silver.cust_info(bronze_cust_info(table_reader(spark, sf_dir)))


def silver_prd_info(spark: SparkSession, sf_dir: str) -> DataFrame:
    return silver.prd_info(bronze_prd_info(table_reader(spark, sf_dir)))


def silver_sales_details(spark: SparkSession, sf_dir: str) -> DataFrame:
    return silver.sales_details(bronze_sales_details(table_reader(spark, sf_dir)))


def silver_cust_az12(spark: SparkSession, sf_dir: str) -> DataFrame:
    return silver.cust_az12(bronze_cust_az12(table_reader(spark, sf_dir)), STANDIN_AS_OF)


def silver_loc_a101(spark: SparkSession, sf_dir: str) -> DataFrame:
    return silver.loc_a101(bronze_loc_a101(table_reader(spark, sf_dir)))


def silver_px_cat_g1v2(spark: SparkSession, sf_dir: str) -> DataFrame:
    return silver.px_cat_g1v2(bronze_px_cat_g1v2(table_reader(spark, sf_dir)))


def gold_dim_customers(spark: SparkSession, sf_dir: str) -> DataFrame:
    s = _silver_frames(spark, sf_dir)
    return gold.dim_customers(s["crm.cust_info"], s["erp.cust_az12"], s["erp.loc_a101"])


def gold_dim_customers_intended(spark: SparkSession, sf_dir: str) -> DataFrame:
    s = _silver_frames(spark, sf_dir)
    return gold.dim_customers(
        s["crm.cust_info"], s["erp.cust_az12"], s["erp.loc_a101"], gender_unknown=GENDER_UNKNOWN_INTENDED
    )


def gold_dim_products(spark: SparkSession, sf_dir: str) -> DataFrame:
    s = _silver_frames(spark, sf_dir)
    return gold.dim_products(s["crm.prd_info"], s["erp.px_cat_g1v2"])


def _fact(s: _Silver, sales: DataFrame | None = None, **opts: bool | str) -> DataFrame:
    """Like the gold runner, the fact joins *written* dimensions: their keys are
    fixed once, and the size of their files decides how they are joined."""
    products = write_scratch(gold.dim_products(s["crm.prd_info"], s["erp.px_cat_g1v2"], **opts), "dim-products")
    customers = write_scratch(
        gold.dim_customers(s["crm.cust_info"], s["erp.cust_az12"], s["erp.loc_a101"], **opts), "dim-customers"
    )
    return gold.fact_sales(s["crm.sales_details"] if sales is None else sales, products, customers, **opts)


def gold_fact_sales(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _fact(_silver_frames(spark, sf_dir))


def gold_fact_sales_merge_joined(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The fact as for dimensions that are too large to broadcast."""
    return _fact(_silver_frames(spark, sf_dir), broadcast=False)


def gold_fact_sales_history(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The fact with the product version that was valid on each order date."""
    s = _silver_frames(spark, sf_dir)
    products = write_scratch(gold.dim_products(s["crm.prd_info"], s["erp.px_cat_g1v2"], history=True), "versions")
    customers = write_scratch(gold.dim_customers(s["crm.cust_info"], s["erp.cust_az12"], s["erp.loc_a101"]), "dim-customers")
    sales = write_scratch(s["crm.sales_details"], "sales")  # as the runner reads it
    return gold.fact_sales(sales, products, customers, history=True)


def pipeline_from_csv(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Source CSV files -> bronze -> silver -> gold with the runner; the fact that it
    publishes."""
    source = export_sources(table_reader(spark, sf_dir), scratch_dir(spark, "source"))
    base = scratch_dir(spark, "lake")
    runner.run_all(spark, base, source, STANDIN_AS_OF, parallelism=2)
    return read_layer(spark, base, "gold", "fact_sales", STANDIN_AS_OF)


# --------------------------------------------------------------- checks, counts

def rule_violations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.check_sales(silver_sales_details(spark, sf_dir))


def fact_rule_violations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.check_fact(gold_fact_sales(spark, sf_dir))


def duplicated_customer_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.duplicated_customers(gold_dim_customers(spark, sf_dir))


def unmatched_categories(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.unmatched_categories(gold_dim_products(spark, sf_dir))


def fact_fanout(spark: SparkSession, sf_dir: str) -> DataFrame:
    s = _silver_frames(spark, sf_dir)
    sales = write_scratch(s["crm.sales_details"], "sales")
    return quality.fact_fanout(sales, _fact(s, sales))


def layer_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    s = _silver_frames(spark, sf_dir)
    counts = [
        s[name].agg(F.count(F.lit(1)).alias("row_count")).select(F.lit(name).alias("dataset"), "row_count")
        for name in SILVER_STANDINS
    ]
    return reduce(DataFrame.unionAll, counts)


# ------------------------------------------------------------ sources and sinks

# A few cell values written into the CSV on purpose: missing-value tokens, a
# token with a leading space (kept), embedded quotes and separators.
CSV_NAME_VARIANTS = ("NA", "n/a", "NULL", "#N/A", " NA", 'say "hi"', "", "nan", "None", "a,b", "two\nlines")
PART_CSV = DatasetSpec(
    "driver",
    "part",
    "part.csv",
    T.StructType(
        [
            T.StructField("p_partkey", T.LongType()),
            T.StructField("p_name", T.StringType()),
            T.StructField("p_brand", T.StringType()),
            T.StructField("p_size", T.LongType()),
            T.StructField("p_retailprice", T.DoubleType()),
        ]
    ),
)


def csv_ingest_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """part -> CSV (with NA tokens, quotes, commas) in the shared scratch folder
    -> typed ingest. Proves quoting, NA handling and numeric casts of SRC-1."""
    p = table_reader(spark, sf_dir)("part")
    k = F.col("p_partkey")
    name = _case(k % 12, list(enumerate(CSV_NAME_VARIANTS)), F.col("p_name"))
    text = p.select(
        k.cast("string").alias("P_PARTKEY"),
        name.alias("p_name"),
        "p_brand",
        F.when(k % 9 == 0, F.lit("NULL")).otherwise(F.col("p_size").cast("string")).alias("p_size"),
        F.when(k % 10 == 0, F.lit("NaN")).when(k % 10 == 1, F.lit(None)).otherwise(F.col("p_retailprice").cast("string")).alias("p_retailprice"),
    )
    folder = scratch_dir(spark, "csv-ingest")
    (
        text.write.option("header", True)
        .option("quote", '"')
        .option("escape", '"')
        .option("ignoreLeadingWhiteSpace", False)
        .option("ignoreTrailingWhiteSpace", False)
        .csv(folder)
    )
    return read_csv_source(spark, folder, PART_CSV).withColumnRenamed("P_PARTKEY", "p_partkey")


def partition_overwrite_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The orders of a day published without renames, as on an object store: a first version,
    files that a killed job left in the day, and the day published anew."""
    orders = table_reader(spark, sf_dir)("orders")
    base, day = scratch_dir(spark, "lake"), "2026-01-01"
    publish_layer(orders.withColumn("o_orderkey", -F.col("o_orderkey")), base, "silver", "orders", day, "driver", protocol="manifest")
    orders.write.mode("append").parquet(partition_path(layer_path(base, "silver", "orders", "driver"), day))
    first = read_layer(spark, base, "silver", "orders", day, "driver").agg(F.count_if(F.col("o_orderkey") > 0).alias("n")).first()["n"]
    publish_layer(orders, base, "silver", "orders", day, "driver", protocol="manifest")
    return read_layer(spark, base, "silver", "orders", day, "driver").withColumn("unpublished_rows", F.lit(first).cast("bigint"))


def csv_type_drift(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The types that the values of a drifted CSV export of part need, by column: sizes that
    became decimals, prices of which some are words, and missing values."""
    p = table_reader(spark, sf_dir)("part")
    k = F.col("p_partkey")
    text = p.select(
        k.cast("string").alias("P_PARTKEY"),
        "p_name",
        F.lit("NA").alias("p_brand"),
        F.when(k % 50 == 3, F.concat(F.col("p_size").cast("string"), F.lit(".5"))).otherwise(F.col("p_size").cast("string")).alias("p_size"),
        F.when(k % 40 == 7, F.lit("on request")).when(k % 10 == 1, F.lit("NaN")).otherwise(F.col("p_retailprice").cast("string")).alias("p_retailprice"),
    )
    folder = scratch_dir(spark, "csv-drift")
    text.write.option("header", True).option("quote", '"').option("escape", '"').csv(folder)
    found = type_drift(spark, folder, PART_CSV).withColumn("column", F.lower("column"))
    return found.select("column", "declared", "needed", "values", "misfits")


def partition_overwrite(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Write two days of a layer dataset, re-run the second day with new content
    and read everything back: day one is untouched, day two replaced."""
    region = table_reader(spark, sf_dir)("region")
    base = scratch_dir(spark, "lake")
    write_layer(region, base, "silver", "region", "2026-01-01", "driver")
    write_layer(region.withColumn("r_name", F.upper("r_name")), base, "silver", "region", "2026-01-02", "driver")
    write_layer(region.withColumn("r_name", F.lower("r_name")), base, "silver", "region", "2026-01-02", "driver")
    days = [
        read_layer(spark, base, "silver", "region", d, "driver").withColumn("ingest_date", F.lit(d))
        for d in ("2026-01-01", "2026-01-02")
    ]
    return days[0].unionByName(days[1])


def publish_gate(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Publish the silver sales of a day with counted rules, then lines with a wrong amount,
    which the gate refuses: the rules of both attempts, and what the day holds after them."""
    sales = silver_sales_details(spark, sf_dir)
    base, day = scratch_dir(spark, "lake"), "2026-01-01"
    first = publish_layer(sales, base, "silver", "sales_details", day, "crm", gate=Gate(quality.sales_rules(), dict.fromkeys(quality.sales_rules(), 1.0)))
    found = [("kept", r, True) for r in first.rules]
    wrong = sales.withColumn("sls_sales", F.when(F.col("sls_quantity") > 25, F.col("sls_sales") + 1).otherwise(F.col("sls_sales")))
    try:
        publish_layer(wrong, base, "silver", "sales_details", day, "crm", gate=quality.sales_gate())
    except QualityGateError as refused:
        found += [("refused", r, False) for r in refused.broken]
    rows = [(attempt, r.rule, r.violations, r.unknown, r.checked, published) for attempt, r, published in found]
    held = read_layer(spark, base, "silver", "sales_details", day, "crm").agg(F.count(F.lit(1)).alias("n"), F.sum("sls_sales").alias("sales")).first()
    counted = spark.createDataFrame(rows, "attempt string, rule string, violations bigint, unknown bigint, checked bigint, published boolean")
    return counted.withColumns({"day_rows": F.lit(held["n"]).cast("bigint"), "day_sales": F.lit(held["sales"]).cast("bigint")})


def partition_overwrite_empty(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Three days of orders; the second is run again without rows, the third never had
    any. Only the first has rows left, and every day can be read."""
    orders = table_reader(spark, sf_dir)("orders")
    nothing = orders.where("o_orderkey IS NULL")
    base = scratch_dir(spark, "lake")
    days = ("2026-01-01", "2026-01-02", "2026-01-03")
    for day, rows in zip((*days, days[1]), (orders, orders, nothing, nothing)):
        write_layer(rows, base, "silver", "orders", day, "driver")
    frames = [read_layer(spark, base, "silver", "orders", d, "driver").withColumn("ingest_date", F.lit(d)) for d in days]
    return reduce(DataFrame.unionByName, frames)


def pass_through_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    return silver.px_cat_g1v2(table_reader(spark, sf_dir)("orders"))


QUERIES: dict[str, Query] = {
    "title_case_names": title_case_names,
    "map_codes_status": map_codes_status,
    "map_codes_normalized": map_codes_normalized,
    "country_names": country_names,
    "keep_latest_order": keep_latest_order,
    "validity_end_orders": validity_end_orders,
    "validity_end_distributed": validity_end_distributed,
    "current_versions": current_versions,
    "split_key": split_key,
    "parse_int_dates": parse_int_dates,
    "repair_sales": repair_sales,
    "strip_prefix_ids": strip_prefix_ids,
    "try_cast_dates": try_cast_dates,
    "null_future_dates": null_future_dates,
    "strip_dashes": strip_dashes,
    "missing_flag": missing_flag_names,
    "gender_fallback": gender_fallback,
    "gender_fallback_intended": gender_fallback_intended,
    "pass_through": pass_through,
    "cast_rounding": cast_rounding,
    "dense_key_distributed": dense_key_distributed,
    "silver_cust_info": silver_cust_info,
    "silver_prd_info": silver_prd_info,
    "silver_sales_details": silver_sales_details,
    "silver_cust_az12": silver_cust_az12,
    "silver_loc_a101": silver_loc_a101,
    "silver_px_cat_g1v2": silver_px_cat_g1v2,
    "gold_dim_customers": gold_dim_customers,
    "gold_dim_customers_intended": gold_dim_customers_intended,
    "gold_dim_products": gold_dim_products,
    "gold_fact_sales": gold_fact_sales,
    "rule_violations": rule_violations,
    "fact_rule_violations": fact_rule_violations,
    "duplicated_customer_keys": duplicated_customer_keys,
    "unmatched_categories": unmatched_categories,
    "fact_fanout": fact_fanout,
    "layer_counts": layer_counts,
    "csv_ingest_roundtrip": csv_ingest_roundtrip,
    "csv_type_drift": csv_type_drift,
    "partition_overwrite": partition_overwrite,
    "partition_overwrite_empty": partition_overwrite_empty,
    "partition_overwrite_manifest": partition_overwrite_manifest,
    "publish_gate": publish_gate,
    "pass_through_orders": pass_through_orders,
    "gold_fact_sales_merge_joined": gold_fact_sales_merge_joined,
    "gold_fact_sales_history": gold_fact_sales_history,
    "pipeline_from_csv": pipeline_from_csv,
}
