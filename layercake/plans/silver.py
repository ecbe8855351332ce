"""Silver layer: one cleaning transform per source dataset (bronze frame -> silver frame).

Each function is pure and lazy; reading and writing partitions is the runner's job.
Output columns and their order are fixed.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from layercake.functions import (
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
from layercake.operators import asc, desc, keep_latest, validity_end

# The code tables of the silver layer.
MARITAL_STATUS = {"S": "Single", "M": "Married"}
CRM_GENDER = {"M": "Male", "F": "Female"}
CRM_UNKNOWN = "Unknown"
PRODUCT_LINE = {"M": "Mountain", "R": "Road", "S": "Other Sales", "T": "Touring"}
ERP_GENDER = {"F": "Female", "FEMALE": "Female", "M": "Male", "MALE": "Male"}
COUNTRY = {"DE": "Germany", "US": "United States", "USA": "United States", "": "n/a"}
NOT_AVAILABLE = "n/a"
ERP_ID_PREFIX = "NAS"
PRODUCT_CATEGORY_LEN = 5

CUST_INFO_COLUMNS = (
    "cst_id", "cst_key", "cst_firstname", "cst_lastname",
    "cst_marital_status", "cst_gndr", "cst_create_date", "dq_missing_name_flag",
)
PRD_INFO_COLUMNS = (
    "prd_id", "cat_id", "prd_key", "prd_nm", "prd_cost", "prd_line", "prd_start_dt", "prd_end_dt",
)
SALES_DETAILS_COLUMNS = (
    "sls_ord_num", "sls_prd_key", "sls_cust_id", "sls_order_dt", "sls_ship_dt",
    "sls_due_dt", "sls_sales", "sls_quantity", "sls_price",
)


def _as_long(df: DataFrame, name: str) -> Column:
    """BIGINT id: integral input is cast as is, floating input rounds half-even."""
    if isinstance(df.schema[name].dataType, T.IntegralType):
        return F.col(name).cast("bigint")
    return round_to_long(name)


def _strict_date(df: DataFrame, name: str) -> Column:
    """DATE with the shapes of ``lenient_date``; any other text raises."""
    c = F.col(name)
    if not isinstance(df.schema[name].dataType, T.StringType):
        return c.cast("date")
    date = lenient_date(name)
    wrong = F.raise_error(F.concat(F.lit(f"{name}: not a date: "), c))
    return F.when(c.isNotNull() & date.isNull(), wrong.cast("date")).otherwise(date)


def cust_info(bronze: DataFrame) -> DataFrame:
    """CRM customers: drop rows without id, keep the latest record per id
    (newest create date, NULL dates last, then a deterministic tie-break on the
    raw attributes), title-case names ('n/a' when empty), decode marital status
    and gender ('Unknown' otherwise), flag missing names."""
    typed = bronze.where(F.col("cst_id").isNotNull()).select(
        _as_long(bronze, "cst_id").alias("cst_id"),
        "cst_key",
        "cst_firstname",
        "cst_lastname",
        "cst_marital_status",
        "cst_gndr",
        lenient_date("cst_create_date").alias("cst_create_date"),
    )
    latest = keep_latest(
        typed,
        ["cst_id"],
        [desc("cst_create_date")],
        tiebreak=[asc(c) for c in ("cst_key", "cst_firstname", "cst_lastname", "cst_marital_status", "cst_gndr")],
    )
    # cleaned once, then used for both the published names and the flag
    cleaned = latest.withColumn("__first", title_case("cst_firstname")).withColumn(
        "__last", title_case("cst_lastname")
    )
    return cleaned.select(
        "cst_id",
        "cst_key",
        F.coalesce("__first", F.lit(NOT_AVAILABLE)).alias("cst_firstname"),
        F.coalesce("__last", F.lit(NOT_AVAILABLE)).alias("cst_lastname"),
        map_codes("cst_marital_status", MARITAL_STATUS, CRM_UNKNOWN).alias("cst_marital_status"),
        map_codes("cst_gndr", CRM_GENDER, CRM_UNKNOWN).alias("cst_gndr"),
        "cst_create_date",
        missing_flag("__first", "__last").alias("dq_missing_name_flag"),
    )


def prd_info(bronze: DataFrame, *, slices: int | None = None) -> DataFrame:
    """CRM products: split 'CA-TE-number' into category id and product number,
    cost NULL -> 0, decode the product line, and recompute each version's end as
    the day before the next version of the same product starts (the source end
    date is discarded). Versions starting on the same day are ordered by id. A start
    that is no date fails the job."""
    cat_id, prd_key = split_composite_key("prd_key", PRODUCT_CATEGORY_LEN, "-", "_")
    typed = bronze.select(
        F.col("prd_id").cast("bigint").alias("prd_id"),
        cat_id.alias("cat_id"),
        prd_key.alias("prd_key"),
        "prd_nm",
        F.coalesce(F.col("prd_cost"), F.lit(0)).cast("double").alias("prd_cost"),
        map_codes("prd_line", PRODUCT_LINE, NOT_AVAILABLE, normalize="upper_trim").alias("prd_line"),
        _strict_date(bronze, "prd_start_dt").alias("prd_start_dt"),
    )
    return validity_end(typed, "prd_key", "prd_start_dt", "prd_end_dt", tiebreak=["prd_id"], slices=slices)


def sales_details(bronze: DataFrame) -> DataFrame:
    """CRM sales lines: yyyymmdd integers -> DATE (invalid -> NULL), and repair
    sales / price (see ``repair_amount``). Row count is unchanged."""
    sales, price = repair_amount("sls_sales", "sls_quantity", "sls_price")
    return bronze.select(
        "sls_ord_num",
        "sls_prd_key",
        "sls_cust_id",
        parse_int_date("sls_order_dt").alias("sls_order_dt"),
        parse_int_date("sls_ship_dt").alias("sls_ship_dt"),
        parse_int_date("sls_due_dt").alias("sls_due_dt"),
        sales.alias("sls_sales"),
        "sls_quantity",
        price.cast("double").alias("sls_price"),
    )


def cust_az12(bronze: DataFrame, as_of: str | dt.date) -> DataFrame:
    """ERP customers: strip the 'NAS' id prefix, birth dates after ``as_of``
    become NULL, decode gender ('n/a' otherwise)."""
    return bronze.select(
        strip_prefix("cid", ERP_ID_PREFIX).alias("cid"),
        null_if_future("bdate", as_of).alias("bdate"),
        map_codes("gen", ERP_GENDER, NOT_AVAILABLE, normalize="upper_trim").alias("gen"),
    )


def loc_a101(bronze: DataFrame) -> DataFrame:
    """ERP locations: drop dashes from ids, decode country codes; blank or NULL
    -> 'n/a'; anything else is kept trimmed, case unchanged."""
    return bronze.select(
        strip_chars("cid", "-").alias("cid"),
        map_codes(
            "cntry", COUNTRY, trim_spaces("cntry"), normalize="trim", null_as=NOT_AVAILABLE
        ).alias("cntry"),
    )


def px_cat_g1v2(bronze: DataFrame) -> DataFrame:
    """ERP product categories: passed through unchanged."""
    return bronze
