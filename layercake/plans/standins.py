"""Driver tables standing in for the CRM / ERP sources.

The driver's tables (customer, part, orders, lineitem, ...) have no NULLs and
no broken references, so each bronze stand-in injects the defects the silver
rules exist for -- deterministically, from the row's own keys (``key % n``
picks which defect a row gets) -- and keeps every row of its table. The only
row-level filters add work: copies appended to the ERP customers (fan-out) and
one category left out of the lookup (unmatched products). ``oracle.py`` builds
the same frames in plain SQL.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

Tables = Callable[[str], DataFrame]

# Fixed values of the stand-ins: the business date used for "future" birth
# dates and the category left out of the lookup (gives unmatched products).
STANDIN_AS_OF = "2010-01-01"
MISSING_CATEGORY = "PR_OM"


def table_reader(spark: SparkSession, sf_dir: str) -> Tables:
    def read(name: str) -> DataFrame:
        return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")

    return read


def case_of(c: Column, pairs: list[tuple[int, Column | str | None]], default: Column | str | None) -> Column:
    """CASE c WHEN k THEN v ... ELSE default (literal or Column values)."""
    def val(v: Column | str | None) -> Column:
        return v if isinstance(v, Column) else F.lit(v).cast("string")

    expr = None
    for k, v in pairs:
        expr = F.when(c == k, val(v)) if expr is None else expr.when(c == k, val(v))
    return expr.otherwise(val(default))


def _iso(c: Column) -> Column:
    return F.date_format(c, "yyyy-MM-dd")


def int_date(c: Column) -> Column:
    """DATE -> yyyymmdd BIGINT."""
    return (F.year(c) * 10000 + F.month(c) * 100 + F.dayofmonth(c)).cast("bigint")


def zero_padded(c: Column, width: int) -> Column:
    """A whole number with at least ``width`` digits; longer ones keep all of theirs. Java's
    formatter is slow for one call per sales line: it is left to negative numbers and NULL."""
    c = c.cast("bigint")
    text = c.cast("string")
    return (
        F.when(c.between(0, 10**width - 1), F.lpad(text, width, "0"))
        .when(c >= 10**width, text)
        .otherwise(F.format_string(f"%0{width}d", c))
    )


def _aw_key(c: Column) -> Column:
    return F.concat(F.lit("AW"), zero_padded(c, 8))


def _product_number(partkey: Column) -> Column:
    return F.concat(F.lit("P"), zero_padded(F.floor(partkey / 3), 5))


# ---------------------------------------------------------------- bronze frames


def bronze_cust_info(t: Tables) -> DataFrame:
    """One customer record per order: the same customer appears with several
    create dates (and ties), noisy names and codes, some NULL ids."""
    o = t("orders")
    k = F.col("o_orderkey")
    base = F.substr(F.col("o_orderpriority"), F.lit(3))
    status = F.concat(F.lit("status "), F.col("o_orderstatus"))
    iso = _iso(F.col("o_orderdate"))
    return o.select(
        F.when(k % 97 == 0, F.lit(None).cast("double"))
        .otherwise(F.col("o_custkey").cast("double"))
        .alias("cst_id"),
        _aw_key(F.col("o_custkey")).alias("cst_key"),
        case_of(
            k % 8,
            [
                (0, base),
                (1, F.concat(F.lit("  "), F.lower(base), F.lit(" "))),
                (2, F.replace(base, F.lit(" "), F.lit("   "))),
                (3, ""),
                (4, None),
                (5, "   "),
                (6, F.concat(base, F.lit("\tx"))),
            ],
            F.lower(base),
        ).alias("cst_firstname"),
        case_of(
            k % 5,
            [(0, None), (1, F.upper(status)), (2, F.concat(F.lit(" "), status)), (3, status)],
            F.concat(status, F.lit("  jr")),
        ).alias("cst_lastname"),
        case_of(k % 5, [(0, "S"), (1, "M"), (2, "s"), (3, None)], "X").alias("cst_marital_status"),
        case_of(k % 4, [(0, "M"), (1, "F"), (2, None)], "U").alias("cst_gndr"),
        F.when(k % 13 == 0, F.lit(None).cast("string"))
        .when(k % 19 == 0, F.substring(iso, 1, 7))
        .when(k % 29 == 0, F.lit("not a date"))
        .when(k % 31 == 0, F.replace(iso, F.lit("-"), F.lit("/")))
        .otherwise(iso)
        .alias("cst_create_date"),
    )


def _category(p_type: Column) -> Column:
    return F.concat(
        F.upper(F.substring(p_type, 1, 2)), F.lit("-"), F.upper(F.substring(p_type, 3, 2))
    )


def bronze_prd_info(t: Tables) -> DataFrame:
    """Three versions per product number (parts 3n, 3n+1, 3n+2), yearly starts,
    some tied starts, short keys, NULL costs and noisy product lines."""
    p = t("part")
    k = F.col("p_partkey")
    key = F.when(k % 53 == 0, F.lit("XX")).otherwise(
        F.concat(_category(F.col("p_type")), F.lit("-"), _product_number(k))
    )
    start = F.when(k % 41 == 0, F.lit("2011-07-01")).otherwise(
        F.concat(F.lit("201"), (k % 3 + 1).cast("string"), F.lit("-07-01"))
    )
    return p.select(
        k.alias("prd_id"),
        key.alias("prd_key"),
        F.col("p_name").alias("prd_nm"),
        F.when(k % 31 == 0, F.lit(None).cast("double")).otherwise(F.col("p_retailprice")).alias("prd_cost"),
        case_of(k % 6, [(0, "M "), (1, "R "), (2, " s"), (3, "T "), (4, None)], "Z").alias("prd_line"),
        start.alias("prd_start_dt"),
        F.lit(None).cast("string").alias("prd_end_dt"),
    )


def bronze_px_cat_g1v2(t: Tables) -> DataFrame:
    """Category lookup derived from the part types (one category left out)."""
    p = t("part").select(
        F.replace(_category(F.col("p_type")), F.lit("-"), F.lit("_")).alias("ID"),
        F.concat(F.upper(F.substring("p_type", 1, 1)), F.lower(F.substr("p_type", F.lit(2)))).alias("CAT"),
        F.concat(F.lit("Sub "), F.lower(F.col("p_type"))).alias("SUBCAT"),
        F.when(F.col("p_type").isin("LARGE", "MEDIUM"), F.lit("Yes")).otherwise(F.lit("No")).alias("MAINTENANCE"),
    )
    return p.distinct().where(F.col("ID") != MISSING_CATEGORY)


def _amountcase_of(m: Column, default: Column, pairs: list[tuple[list[int], Column | None]]) -> Column:
    expr = None
    for ks, v in pairs:
        value = v if v is not None else F.lit(None).cast("bigint")
        cond = m.isin(ks)
        expr = F.when(cond, value) if expr is None else expr.when(cond, value)
    return expr.otherwise(default)


def bronze_sales_details(t: Tables) -> DataFrame:
    """Sales lines (lineitem joined to its order): yyyymmdd dates with every
    defect class, amounts covering the repair truth table, orphan and NULL
    product / customer references."""
    li = t("lineitem").select(
        "l_orderkey", "l_partkey", "l_linenumber", "l_quantity", "l_extendedprice", "l_shipdate"
    )
    o = t("orders").select("o_orderkey", "o_custkey", int_date(F.col("o_orderdate")).alias("od"))
    ok, ln, pk = F.col("l_orderkey"), F.col("l_linenumber"), F.col("l_partkey")
    m = (ok * 7 + ln) % 14
    # what several columns use is computed once per row: as parts of each of them it made
    # generated methods too large for the JVM to compile
    each = F.floor(F.col("l_extendedprice") / F.col("l_quantity")).cast("bigint")
    j = li.join(o, li.l_orderkey == o.o_orderkey, "inner").select(
        "l_orderkey",
        "l_partkey",
        "l_linenumber",
        "o_custkey",
        "od",
        F.to_date("l_shipdate").alias("ship"),
        F.col("l_quantity").cast("bigint").alias("q"),
        F.when(m == 6, F.lit(None)).otherwise(each).alias("p"),  # 6: neither amount nor price
        m.alias("m"),
        ((ok + ln) % 10).alias("dm"),
    )
    od, ship, q, p, m, dm = (F.col(c) for c in ("od", "ship", "q", "p", "m", "dm"))
    s = q * p
    order_dt = (
        F.when(dm == 0, F.lit(0).cast("bigint"))
        .when(dm == 1, F.floor(od / 1000).cast("bigint"))
        .when(dm == 2, od + 1200)
        .when(dm == 3, F.lit(None).cast("bigint"))
        .when(dm == 4, -F.floor(od / 10).cast("bigint"))
        .when(dm == 5, F.lit(20230229).cast("bigint"))
        .when(dm == 6, od * 10)
        .when(dm == 7, F.lit(20240229).cast("bigint"))
        .otherwise(od)
    )
    return j.select(
        F.concat(F.lit("SO"), ok.cast("string")).alias("sls_ord_num"),
        F.when(pk % 101 == 0, F.concat(F.lit("ORPHAN-"), pk.cast("string")))
        .otherwise(_product_number(pk))
        .alias("sls_prd_key"),
        F.when(ok % 89 == 0, F.lit(None).cast("bigint"))
        .when(ok % 83 == 0, F.col("o_custkey") + 1_000_000_000)
        .otherwise(F.col("o_custkey"))
        .alias("sls_cust_id"),
        order_dt.alias("sls_order_dt"),
        F.when(ln % 7 == 0, F.lit(0).cast("bigint")).otherwise(int_date(ship)).alias("sls_ship_dt"),
        F.when(ok % 11 == 0, F.lit(None).cast("bigint"))
        .otherwise(int_date(F.date_add(ship, 30)))
        .alias("sls_due_dt"),
        _amountcase_of(m, s, [([1, 6, 12], None), ([2], F.lit(0).cast("bigint")), ([3, 13], -s), ([4], s + 1)]).alias("sls_sales"),
        _amountcase_of(m, q, [([9, 10], F.lit(0).cast("bigint")), ([11], None)]).alias("sls_quantity"),
        _amountcase_of(m, p, [([5, 6, 10, 13], None), ([7], F.lit(0).cast("bigint")), ([8, 12], -p)]).alias("sls_price"),
    )


def bronze_cust_az12(t: Tables) -> DataFrame:
    """ERP customer attributes: 'NAS'-prefixed ids (and a lower-case 'nas' that
    is not stripped), birth dates in several shapes and after the business date,
    noisy gender codes, and duplicated ids (fan-out)."""
    c = t("customer").select("c_custkey")
    k = F.col("c_custkey")
    key = _aw_key(k)
    born = F.date_add(F.lit("1940-01-01").cast("date"), ((k * 37) % 30000).cast("int"))
    iso = _iso(born)

    def frame(gen: Column) -> DataFrame:
        return c.select(
            case_of(k % 5, [(0, F.concat(F.lit("NAS"), key)), (1, F.concat(F.lit("nas"), key))], key).alias("cid"),
            F.when(k % 17 == 0, F.lit(None).cast("string"))
            .when(k % 19 == 0, F.lit("unknown"))
            .when(k % 23 == 0, F.replace(iso, F.lit("-"), F.lit("/")))
            .when(k % 29 == 0, F.lit(STANDIN_AS_OF))
            .otherwise(iso)
            .alias("bdate"),
            gen.alias("gen"),
        )

    gen = case_of(
        k % 8,
        [(0, "F"), (1, "Female"), (2, "FEMALE "), (3, " m"), (4, "Male"), (5, ""), (6, "X")],
        None,
    )
    copies = frame(F.lit("M")).where(k % 50 == 0)
    return frame(gen).unionAll(copies)


def bronze_loc_a101(t: Tables) -> DataFrame:
    """ERP customer country codes with dashes in the ids."""
    c = t("customer").select("c_custkey", "c_nationkey")
    k = F.col("c_custkey")
    padded = zero_padded(k, 8)
    return c.select(
        F.when(k % 37 == 0, F.lit(None).cast("string"))
        .when(k % 7 == 0, F.concat(F.lit("A-W-"), padded))
        .otherwise(F.concat(F.lit("AW-"), padded))
        .alias("cid"),
        case_of(
            F.col("c_nationkey") % 8,
            [(0, "DE"), (1, "US"), (2, "USA "), (3, ""), (4, "  "), (5, None), (6, " France ")],
            "de",
        ).alias("cntry"),
    )


BRONZE_STANDINS: dict[str, Callable[[Tables], DataFrame]] = {
    "crm.cust_info": bronze_cust_info,
    "crm.prd_info": bronze_prd_info,
    "crm.sales_details": bronze_sales_details,
    "erp.cust_az12": bronze_cust_az12,
    "erp.loc_a101": bronze_loc_a101,
    "erp.px_cat_g1v2": bronze_px_cat_g1v2,
}


def export_sources(t: Tables, folder: str) -> str:
    """Write the six bronze stand-ins as source CSVs laid out like the real
    drop folder (``<folder>/<source>/<file>``, each a folder of part files), so
    the whole pipeline -- CSV ingest included -- can run on driver-table data."""
    from layercake.sources import all_datasets

    for spec in all_datasets():
        frame = BRONZE_STANDINS[spec.qualified](t)
        (
            frame.write.mode("overwrite")
            .option("header", True)
            .option("quote", '"')
            .option("escape", '"')
            .option("ignoreLeadingWhiteSpace", False)
            .option("ignoreTrailingWhiteSpace", False)
            .csv(f"{folder.rstrip('/')}/{spec.source}/{spec.source_file}")
        )
    return folder
