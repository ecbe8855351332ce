"""SQL (DuckDB dialect) for every query of ``driver_queries``.

Written over the driver's tables -- the bronze stand-ins, the silver and gold
rules, the operator demonstrations -- so the Spark results can be compared with
an engine that does not share any of this package's code.
"""

from __future__ import annotations


def title_sql(x: str) -> str:
    """Words numbered, cased one by one and put together again."""
    words = f"string_split(regexp_replace(trim({x}), '\\s+', ' ', 'g'), ' ')"
    return (
        "(SELECT nullif(string_agg(upper(one[1]) || lower(one[2:]), ' ' ORDER BY place), '') "
        f"FROM (SELECT unnest({words}) AS one, unnest(range(len({words}))) AS place))"
    )


def lookup_sql(pairs: dict[str, str]) -> str:
    """A code table: rows (code, label)."""
    return "(VALUES " + ", ".join(f"('{code}', '{label}')" for code, label in pairs.items()) + ")"


def _with(ctes: list[str], final: str) -> str:
    return "WITH " + ",\n".join(f"{name} AS ({CTE[name]})" for name in ctes) + "\n" + final


ISO_ORDER = "strftime(o_orderdate, '%Y-%m-%d')"
BASE_PRIORITY = "substring(o_orderpriority, 3)"
STATUS = "('status ' || o_orderstatus)"

CTE: dict[str, str] = {}

CTE["bronze_cust_info"] = f"""
SELECT
  CASE WHEN o_orderkey % 97 = 0 THEN NULL ELSE CAST(o_custkey AS DOUBLE) END AS cst_id,
  'AW' || format('{{:08d}}', o_custkey) AS cst_key,
  CASE o_orderkey % 8
    WHEN 0 THEN {BASE_PRIORITY}
    WHEN 1 THEN '  ' || lower({BASE_PRIORITY}) || ' '
    WHEN 2 THEN replace({BASE_PRIORITY}, ' ', '   ')
    WHEN 3 THEN ''
    WHEN 4 THEN NULL
    WHEN 5 THEN '   '
    WHEN 6 THEN {BASE_PRIORITY} || chr(9) || 'x'
    ELSE lower({BASE_PRIORITY}) END AS cst_firstname,
  CASE o_orderkey % 5
    WHEN 0 THEN NULL
    WHEN 1 THEN upper({STATUS})
    WHEN 2 THEN ' ' || {STATUS}
    WHEN 3 THEN {STATUS}
    ELSE {STATUS} || '  jr' END AS cst_lastname,
  CASE o_orderkey % 5 WHEN 0 THEN 'S' WHEN 1 THEN 'M' WHEN 2 THEN 's' WHEN 3 THEN NULL ELSE 'X' END
    AS cst_marital_status,
  CASE o_orderkey % 4 WHEN 0 THEN 'M' WHEN 1 THEN 'F' WHEN 2 THEN NULL ELSE 'U' END AS cst_gndr,
  CASE WHEN o_orderkey % 13 = 0 THEN NULL
       WHEN o_orderkey % 19 = 0 THEN substring({ISO_ORDER}, 1, 7)
       WHEN o_orderkey % 29 = 0 THEN 'not a date'
       WHEN o_orderkey % 31 = 0 THEN replace({ISO_ORDER}, '-', '/')
       ELSE {ISO_ORDER} END AS cst_create_date
FROM orders
"""

CATEGORY = "upper(substring(p_type, 1, 2)) || '-' || upper(substring(p_type, 3, 2))"

CTE["bronze_prd_info"] = f"""
SELECT
  p_partkey AS prd_id,
  CASE WHEN p_partkey % 53 = 0 THEN 'XX'
       ELSE {CATEGORY} || '-' || 'P' || format('{{:05d}}', p_partkey // 3) END AS prd_key,
  p_name AS prd_nm,
  CASE WHEN p_partkey % 31 = 0 THEN NULL ELSE p_retailprice END AS prd_cost,
  CASE p_partkey % 6 WHEN 0 THEN 'M ' WHEN 1 THEN 'R ' WHEN 2 THEN ' s' WHEN 3 THEN 'T ' WHEN 4 THEN NULL
       ELSE 'Z' END AS prd_line,
  CASE WHEN p_partkey % 41 = 0 THEN '2011-07-01'
       ELSE '201' || CAST(p_partkey % 3 + 1 AS VARCHAR) || '-07-01' END AS prd_start_dt,
  CAST(NULL AS VARCHAR) AS prd_end_dt
FROM part
"""

CTE["bronze_px_cat_g1v2"] = f"""
SELECT * FROM (
  SELECT DISTINCT
    replace({CATEGORY}, '-', '_') AS ID,
    upper(substring(p_type, 1, 1)) || lower(substring(p_type, 2)) AS CAT,
    'Sub ' || lower(p_type) AS SUBCAT,
    CASE WHEN p_type IN ('LARGE', 'MEDIUM') THEN 'Yes' ELSE 'No' END AS MAINTENANCE
  FROM part)
WHERE ID != 'PR_OM'
"""

CTE["bronze_sales_details"] = """
SELECT
  'SO' || CAST(l_orderkey AS VARCHAR) AS sls_ord_num,
  CASE WHEN l_partkey % 101 = 0 THEN 'ORPHAN-' || CAST(l_partkey AS VARCHAR)
       ELSE 'P' || format('{:05d}', l_partkey // 3) END AS sls_prd_key,
  CASE WHEN l_orderkey % 89 = 0 THEN NULL
       WHEN l_orderkey % 83 = 0 THEN o_custkey + 1000000000
       ELSE o_custkey END AS sls_cust_id,
  CASE (l_orderkey + l_linenumber) % 10
       WHEN 0 THEN 0 WHEN 1 THEN od // 1000 WHEN 2 THEN od + 1200 WHEN 3 THEN NULL
       WHEN 4 THEN -(od // 10) WHEN 5 THEN 20230229 WHEN 6 THEN od * 10 WHEN 7 THEN 20240229
       ELSE od END AS sls_order_dt,
  CASE WHEN l_linenumber % 7 = 0 THEN 0 ELSE sd END AS sls_ship_dt,
  CASE WHEN l_orderkey % 11 = 0 THEN NULL ELSE dd END AS sls_due_dt,
  CASE WHEN m IN (1, 6, 12) THEN NULL WHEN m = 2 THEN 0 WHEN m IN (3, 13) THEN -(q * p)
       WHEN m = 4 THEN q * p + 1 ELSE q * p END AS sls_sales,
  CASE WHEN m IN (9, 10) THEN 0 WHEN m = 11 THEN NULL ELSE q END AS sls_quantity,
  CASE WHEN m IN (5, 6, 10, 13) THEN NULL WHEN m = 7 THEN 0 WHEN m IN (8, 12) THEN -p ELSE p END
    AS sls_price
FROM (
  SELECT l.l_orderkey, l.l_partkey, l.l_linenumber, o.o_custkey,
    (l.l_orderkey * 7 + l.l_linenumber) % 14 AS m,
    CAST(l.l_quantity AS BIGINT) AS q,
    CAST(floor(l.l_extendedprice / l.l_quantity) AS BIGINT) AS p,
    CAST(year(o.o_orderdate) * 10000 + month(o.o_orderdate) * 100 + day(o.o_orderdate) AS BIGINT) AS od,
    CAST(year(l.l_shipdate) * 10000 + month(l.l_shipdate) * 100 + day(l.l_shipdate) AS BIGINT) AS sd,
    CAST(year(CAST(l.l_shipdate AS DATE) + 30) * 10000 + month(CAST(l.l_shipdate AS DATE) + 30) * 100
         + day(CAST(l.l_shipdate AS DATE) + 30) AS BIGINT) AS dd
  FROM lineitem l JOIN orders o ON l.l_orderkey = o.o_orderkey)
"""

_AZ_CID = """CASE c_custkey % 5 WHEN 0 THEN 'NAS' || key WHEN 1 THEN 'nas' || key ELSE key END AS cid,
  CASE WHEN c_custkey % 17 = 0 THEN NULL
       WHEN c_custkey % 19 = 0 THEN 'unknown'
       WHEN c_custkey % 23 = 0 THEN replace(iso, '-', '/')
       WHEN c_custkey % 29 = 0 THEN '2010-01-01'
       ELSE iso END AS bdate"""

CTE["bronze_cust_az12"] = f"""
SELECT {_AZ_CID},
  CASE c_custkey % 8 WHEN 0 THEN 'F' WHEN 1 THEN 'Female' WHEN 2 THEN 'FEMALE ' WHEN 3 THEN ' m'
       WHEN 4 THEN 'Male' WHEN 5 THEN '' WHEN 6 THEN 'X' ELSE NULL END AS gen
FROM (SELECT c_custkey, 'AW' || format('{{:08d}}', c_custkey) AS key,
        strftime(DATE '1940-01-01' + CAST((c_custkey * 37) % 30000 AS INTEGER), '%Y-%m-%d') AS iso
      FROM customer)
UNION ALL
SELECT {_AZ_CID}, 'M' AS gen
FROM (SELECT c_custkey, 'AW' || format('{{:08d}}', c_custkey) AS key,
        strftime(DATE '1940-01-01' + CAST((c_custkey * 37) % 30000 AS INTEGER), '%Y-%m-%d') AS iso
      FROM customer)
WHERE c_custkey % 50 = 0
"""

CTE["bronze_loc_a101"] = """
SELECT
  CASE WHEN c_custkey % 37 = 0 THEN NULL
       WHEN c_custkey % 7 = 0 THEN 'A-W-' || format('{:08d}', c_custkey)
       ELSE 'AW-' || format('{:08d}', c_custkey) END AS cid,
  CASE c_nationkey % 8 WHEN 0 THEN 'DE' WHEN 1 THEN 'US' WHEN 2 THEN 'USA ' WHEN 3 THEN ''
       WHEN 4 THEN '  ' WHEN 5 THEN NULL WHEN 6 THEN ' France ' ELSE 'de' END AS cntry
FROM customer
"""

# ---------------------------------------------------------------- silver

MARITAL = {"S": "Single", "M": "Married"}
GENDER = {"M": "Male", "F": "Female"}
LINES = {"M": "Mountain", "R": "Road", "S": "Other Sales", "T": "Touring"}
COUNTRIES = {"DE": "Germany", "US": "United States", "USA": "United States", "": "n/a"}

# The record of a customer is the least one under a struct that orders them: newest day
# first, unknown days last, then the texts, NULL after all others.
_TEXTS = ("cst_key", "cst_firstname", "cst_lastname", "cst_marital_status", "cst_gndr")
_RECORD_ORDER = "struct_pack(age := coalesce(-datediff('day', DATE '1970-01-01', made), 9999999), " + ", ".join(
    f"missing_{c} := {c} IS NULL, text_{c} := coalesce({c}, '')" for c in _TEXTS
) + ")"

CTE["silver_cust_info"] = f"""
SELECT chosen.id AS cst_id, chosen.cst_key,
  coalesce(names.given, 'n/a') AS cst_firstname,
  coalesce(names.family, 'n/a') AS cst_lastname,
  coalesce(marital.label, 'Unknown') AS cst_marital_status,
  coalesce(gender.label, 'Unknown') AS cst_gndr,
  chosen.made AS cst_create_date,
  (names.given IS NULL) OR (names.family IS NULL) AS dq_missing_name_flag
FROM (
  SELECT unnest(min_by(record, {_RECORD_ORDER}))
  FROM (SELECT *, struct_pack(id := cst_id::BIGINT, cst_key := cst_key, cst_firstname := cst_firstname,
            cst_lastname := cst_lastname, status := cst_marital_status, sex := cst_gndr, made := made) AS record
        FROM (SELECT *, TRY_CAST(cst_create_date AS DATE) AS made FROM bronze_cust_info))
  GROUP BY cst_id::BIGINT HAVING cst_id::BIGINT IS NOT NULL) AS chosen
CROSS JOIN LATERAL (SELECT {title_sql('chosen.cst_firstname')} AS given, {title_sql('chosen.cst_lastname')} AS family) AS names
LEFT JOIN {lookup_sql(MARITAL)} AS marital(code, label) ON marital.code = chosen.status
LEFT JOIN {lookup_sql(GENDER)} AS gender(code, label) ON gender.code = chosen.sex
"""

CTE["silver_prd_info"] = f"""
SELECT here.prd_id, here.category AS cat_id, here.number AS prd_key, here.prd_nm, here.cost AS prd_cost,
  here.line AS prd_line, here.since AS prd_start_dt, following.since - 1 AS prd_end_dt
FROM versions AS here
LEFT JOIN versions AS following ON following.number = here.number AND following.version = here.version + 1
"""
CTE["versions"] = f"""
SELECT *, row_number() OVER (PARTITION BY number ORDER BY since NULLS LAST, prd_id NULLS LAST) AS version
FROM (SELECT prd_id, prd_nm, translate(prd_key[:5], '-', '_') AS category, prd_key[7:] AS number,
        ifnull(prd_cost, 0) AS cost, ifnull(line.label, 'n/a') AS line, prd_start_dt::DATE AS since
      FROM bronze_prd_info LEFT JOIN {lookup_sql(LINES)} AS line(code, label) ON line.code = upper(trim(prd_line)))
"""


def _int_date_sql(c: str) -> str:
    """From the digits: a day of the calendar or NULL. Parts are put in range first."""
    digits = f"(CASE WHEN {c} BETWEEN 10000000 AND 99999999 THEN {c} ELSE 20000101 END)"
    year, month, day = f"({digits} // 10000)", f"({digits} // 100 % 100)", f"({digits} % 100)"
    first = f"make_date({year}, greatest(1, least(12, {month})), 1)"
    return (
        f"CASE WHEN {c} BETWEEN 10000000 AND 99999999 AND {month} BETWEEN 1 AND 12 "
        f"AND {day} BETWEEN 1 AND day(last_day({first})) THEN CAST({first} + CAST({day} - 1 AS INTEGER) AS DATE) END"
    )


CTE["silver_sales_details"] = f"""
SELECT sls_ord_num, sls_prd_key, sls_cust_id,
  {_int_date_sql('sls_order_dt')} AS sls_order_dt,
  {_int_date_sql('sls_ship_dt')} AS sls_ship_dt,
  {_int_date_sql('sls_due_dt')} AS sls_due_dt,
  if(plausible, sls_sales, expected) AS sls_sales,
  sls_quantity,
  if(sls_price > 0, sls_price, sls_sales / nullif(sls_quantity, 0)) AS sls_price
FROM (SELECT *, sls_sales > 0 AND coalesce(sls_sales = expected, TRUE) AS plausible
      FROM (SELECT *, abs(sls_price) * sls_quantity AS expected FROM bronze_sales_details))
"""

CTE["silver_cust_az12"] = f"""
SELECT regexp_replace(cid, '^NAS', '') AS cid,
  if(born <= DATE '2010-01-01', born, NULL) AS bdate,
  ifnull(gender.label, 'n/a') AS gen
FROM (SELECT *, TRY_CAST(bdate AS DATE) AS born, upper(trim(gen)) AS sex FROM bronze_cust_az12)
LEFT JOIN {lookup_sql({**GENDER, "MALE": "Male", "FEMALE": "Female"})} AS gender(code, label) ON gender.code = sex
"""

CTE["silver_loc_a101"] = "SELECT translate(cid, '-', '') AS cid, coalesce(label, place_name, 'n/a') AS cntry FROM located"
CTE["located"] = f"""
SELECT cid, trim(cntry) AS place_name, label
FROM bronze_loc_a101 LEFT JOIN {lookup_sql(COUNTRIES)} AS named(code, label) ON named.code = trim(cntry)
"""

CTE["silver_px_cat_g1v2"] = "SELECT * FROM bronze_px_cat_g1v2"

# ---------------------------------------------------------------- gold


def _numbered(key: str, table: str, order: str) -> str:
    """Rows of ``table`` numbered from 1 by the listed columns, NULLs last."""
    return f"SELECT row_number() OVER (ORDER BY {', '.join(c + ' NULLS LAST' for c in order.split())}) AS {key}, * FROM ({table})"


def _dim_customers_sql(crm_gender: str) -> str:
    people = f"""
  SELECT person.customer_id, customer_number, person.first_name, person.last_name, home.country,
    person.marital_status, coalesce({crm_gender}, born.gender, 'n/a') AS gender, born.birthdate, person.create_date
  FROM (SELECT cst_key AS customer_number, cst_id AS customer_id, cst_firstname AS first_name, cst_lastname AS last_name,
          cst_marital_status AS marital_status, cst_gndr AS gender, cst_create_date AS create_date
        FROM silver_cust_info) AS person
  LEFT JOIN (SELECT cid AS customer_number, cntry AS country FROM silver_loc_a101) AS home USING (customer_number)
  LEFT JOIN (SELECT cid AS customer_number, gen AS gender, bdate AS birthdate FROM silver_cust_az12) AS born USING (customer_number)"""
    order = "customer_id customer_number first_name last_name country marital_status gender birthdate create_date"
    return _numbered("customer_key", people, order)


CTE["gold_dim_customers"] = _dim_customers_sql("nullif(person.gender, 'n/a')")
CTE["gold_dim_customers_intended"] = _dim_customers_sql("nullif(nullif(person.gender, 'n/a'), 'Unknown')")

CTE["gold_dim_products"] = _numbered(
    "product_key",
    """
  SELECT prd_id AS product_id, prd_key AS product_number, prd_nm AS product_name, category_id, category, subcategory,
    maintenance, prd_cost AS cost, prd_line AS product_line, prd_start_dt AS start_date
  FROM (SELECT * RENAME (cat_id AS category_id) FROM silver_prd_info) AS version
  LEFT JOIN (SELECT id AS category_id, cat AS category, subcat AS subcategory, maintenance AS maintenance
             FROM silver_px_cat_g1v2) AS category USING (category_id)
  WHERE prd_end_dt IS NULL""",
    "start_date product_number product_id product_name category_id category subcategory maintenance cost product_line",
)

CTE["product_versions"] = CTE["gold_dim_products"].replace("WHERE prd_end_dt IS NULL", "")

CTE["gold_fact_sales_history"] = """
SELECT sls_ord_num AS order_number, product_key, customer_key, sls_order_dt AS order_date,
  sls_ship_dt AS shipping_date, sls_due_dt AS due_date, sls_sales AS sales_amount,
  sls_quantity AS quantity, sls_price AS price
FROM (SELECT * RENAME (sls_prd_key AS product_number, sls_cust_id AS customer_id) FROM silver_sales_details) AS line
LEFT JOIN (SELECT customer_id, customer_key FROM gold_dim_customers) AS customer USING (customer_id)
ASOF LEFT JOIN (
  SELECT product_number, start_date, max(product_key) AS product_key FROM product_versions GROUP BY ALL
) AS version ON version.product_number = line.product_number AND version.start_date <= line.sls_order_dt
"""

CTE["gold_fact_sales"] = """
SELECT sls_ord_num AS order_number, product_key, customer_key, sls_order_dt AS order_date,
  sls_ship_dt AS shipping_date, sls_due_dt AS due_date, sls_sales AS sales_amount,
  sls_quantity AS quantity, sls_price AS price
FROM (SELECT * RENAME (sls_prd_key AS product_number, sls_cust_id AS customer_id) FROM silver_sales_details) AS line
LEFT JOIN (SELECT customer_id, customer_key FROM gold_dim_customers) AS customer USING (customer_id)
LEFT JOIN (SELECT product_number, product_key FROM gold_dim_products) AS product USING (product_number)
"""

SILVER_CHAIN = {
    "silver_cust_info": ["bronze_cust_info"],
    "silver_prd_info": ["bronze_prd_info", "versions"],
    "silver_sales_details": ["bronze_sales_details"],
    "silver_cust_az12": ["bronze_cust_az12"],
    "silver_loc_a101": ["bronze_loc_a101", "located"],
    "silver_px_cat_g1v2": ["bronze_px_cat_g1v2"],
}
SILVER_DATASETS = {
    "crm.cust_info": "silver_cust_info",
    "crm.prd_info": "silver_prd_info",
    "crm.sales_details": "silver_sales_details",
    "erp.cust_az12": "silver_cust_az12",
    "erp.loc_a101": "silver_loc_a101",
    "erp.px_cat_g1v2": "silver_px_cat_g1v2",
}
ALL_SILVER = [c for name, deps in SILVER_CHAIN.items() for c in (*deps, name)]
CUSTOMER_CHAIN = [
    "bronze_cust_info", "silver_cust_info", "bronze_cust_az12", "silver_cust_az12",
    "bronze_loc_a101", "located", "silver_loc_a101",
]
PRODUCT_CHAIN = ["bronze_prd_info", "versions", "silver_prd_info", "bronze_px_cat_g1v2", "silver_px_cat_g1v2"]


def _dataset(name: str, deps: list[str]) -> str:
    return _with(deps, f"SELECT * FROM {name}") if deps else CTE[name]


# ---------------------------------------------------------------- operators

DATE_STRINGS = f"""CASE o_orderkey % 10
    WHEN 0 THEN {ISO_ORDER}
    WHEN 1 THEN replace({ISO_ORDER}, '-', '/')
    WHEN 2 THEN 'garbage'
    WHEN 3 THEN NULL
    WHEN 4 THEN substring({ISO_ORDER}, 1, 7)
    WHEN 5 THEN {ISO_ORDER} || ' 10:30:00'
    WHEN 6 THEN {ISO_ORDER} || 'T08:15'
    WHEN 7 THEN ' ' || {ISO_ORDER}
    WHEN 8 THEN strftime(o_orderdate, '%Y-%-m-%-d')
    ELSE replace({ISO_ORDER}, '-', ' ') END"""

GENDERS = """SELECT c_custkey,
  CASE c_custkey % 6 WHEN 0 THEN 'Male' WHEN 1 THEN 'Female' WHEN 2 THEN 'n/a' WHEN 3 THEN 'Unknown'
       WHEN 4 THEN NULL ELSE 'Female' END AS crm_gender,
  CASE c_custkey % 4 WHEN 0 THEN NULL WHEN 1 THEN 'Male' WHEN 2 THEN 'Female' ELSE 'n/a' END AS erp_gender
FROM customer"""

VALIDITY = """WITH versions AS (
  SELECT o_orderkey, o_custkey, if(o_orderkey % 17 = 0, NULL, CAST(o_orderdate AS DATE)) AS valid_from,
    rank() OVER (PARTITION BY o_custkey ORDER BY valid_from NULLS LAST, o_orderkey) AS nth
  FROM orders
)
SELECT this.o_orderkey, o_custkey, this.valid_from, following.valid_from - 1 AS valid_to
FROM versions AS this LEFT JOIN (SELECT o_custkey, nth - 1 AS nth, valid_from FROM versions) AS following USING (o_custkey, nth)"""

RULES = {
    "sales_equals_quantity_times_price": "sls_sales = sls_quantity * abs(sls_price)",
    "price_positive": "sls_price > 0",
    "quantity_positive": "sls_quantity > 0",
    "order_not_after_ship": "sls_order_dt <= sls_ship_dt",
}

# The missing-value tokens of the CSV reader (see sources.csv).
NA_LIST = (
    "'', '#N/A', '#N/A N/A', '#NA', '-1.#IND', '-1.#QNAN', '-NaN', '-nan', '1.#IND', '1.#QNAN', "
    "'<NA>', 'N/A', 'NA', 'NULL', 'NaN', 'None', 'n/a', 'nan', 'null'"
)
CSV_NAMES = """CASE p_partkey % 12 WHEN 0 THEN 'NA' WHEN 1 THEN 'n/a' WHEN 2 THEN 'NULL' WHEN 3 THEN '#N/A'
    WHEN 4 THEN ' NA' WHEN 5 THEN 'say "hi"' WHEN 6 THEN '' WHEN 7 THEN 'nan' WHEN 8 THEN 'None'
    WHEN 9 THEN 'a,b' WHEN 10 THEN 'two' || chr(10) || 'lines' ELSE p_name END"""

FACT_RULES = {
    "product_resolved": "product_key IS NOT NULL",
    "customer_resolved": "customer_key IS NOT NULL",
    "order_date_present": "order_date IS NOT NULL",
    "amount_equals_quantity_times_price": "sales_amount = quantity * abs(price)",
}
FACT_CHAIN = [
    *CUSTOMER_CHAIN, "gold_dim_customers", *PRODUCT_CHAIN, "gold_dim_products",
    "bronze_sales_details", "silver_sales_details", "gold_fact_sales",
]


def _rules_sql(table: str, rules: dict[str, str]) -> str:
    return "\nUNION ALL\n".join(
        f"SELECT '{name}' AS rule, CAST(count_if(NOT ({pred})) AS BIGINT) AS violations, "
        f"CAST(count_if(({pred}) IS NULL) AS BIGINT) AS unknown, CAST(count(*) AS BIGINT) AS checked "
        f"FROM {table}"
        for name, pred in rules.items()
    )


ORACLE_SQL: dict[str, str] = {
    "title_case_names": f"""
SELECT p_partkey, p_name_raw, {title_sql('p_name_raw')} AS p_name_title
FROM (SELECT p_partkey,
        CASE p_partkey % 8 WHEN 0 THEN '  ' || upper(p_name) || ' ' WHEN 1 THEN replace(p_name, ' ', '   ')
             WHEN 2 THEN '' WHEN 3 THEN NULL WHEN 4 THEN '   ' WHEN 5 THEN p_name || chr(9) || 'END'
             WHEN 6 THEN 'mIxEd ΝΙΚΟΣ ßeta éTÉ ñU ' || p_name ELSE p_name END AS p_name_raw
      FROM part)""",
    "map_codes_status": """
SELECT o_orderkey, o_orderstatus_raw,
  CASE o_orderstatus_raw WHEN 'F' THEN 'Fulfilled' WHEN 'O' THEN 'Open' WHEN 'P' THEN 'Partial'
       ELSE 'Unknown' END AS order_status
FROM (SELECT o_orderkey, CASE WHEN o_orderkey % 11 = 0 THEN NULL WHEN o_orderkey % 13 = 0 THEN 'X'
                              ELSE o_orderstatus END AS o_orderstatus_raw FROM orders)""",
    "map_codes_normalized": """
SELECT event_id, event_type_raw,
  CASE WHEN upper(trim(event_type_raw)) IN ('CLICK', 'VIEW') THEN 'Engagement'
       WHEN upper(trim(event_type_raw)) IN ('PURCHASE', 'SIGNUP') THEN 'Conversion'
       ELSE 'n/a' END AS event_class
FROM (SELECT event_id, CASE event_id % 6 WHEN 0 THEN upper(event_type) WHEN 1 THEN '  ' || event_type || ' '
                            WHEN 2 THEN NULL WHEN 3 THEN upper(' ' || event_type) ELSE event_type END
             AS event_type_raw FROM events)""",
    "country_names": """
SELECT c_custkey, cntry_raw,
  CASE WHEN trim(cntry_raw) = 'DE' THEN 'Germany'
       WHEN trim(cntry_raw) IN ('US', 'USA') THEN 'United States'
       WHEN trim(cntry_raw) = '' OR cntry_raw IS NULL THEN 'n/a'
       ELSE trim(cntry_raw) END AS country
FROM (SELECT c_custkey, CASE c_custkey % 9 WHEN 0 THEN 'DE' WHEN 1 THEN ' US' WHEN 2 THEN 'USA ' WHEN 3 THEN ''
                             WHEN 4 THEN NULL WHEN 5 THEN '   ' WHEN 6 THEN ' France ' WHEN 7 THEN 'de'
                             ELSE c_mktsegment END AS cntry_raw FROM customer)""",
    "keep_latest_order": """
SELECT o_orderkey, o_custkey, o_totalprice, order_date
FROM (SELECT o_orderkey, o_custkey, o_totalprice,
        CASE WHEN o_orderkey % 10 = 0 THEN NULL ELSE CAST(o_orderdate AS DATE) END AS order_date
      FROM orders)
QUALIFY row_number() OVER (PARTITION BY o_custkey ORDER BY order_date DESC NULLS LAST,
                           o_orderkey DESC NULLS LAST) = 1""",
    "validity_end_orders": VALIDITY,
    "validity_end_distributed": VALIDITY,
    "current_versions": f"SELECT * FROM ({VALIDITY}) WHERE valid_to IS NULL",
    "split_key": """
SELECT p_partkey, raw_key, translate(raw_key[:5], '-', '_') AS cat_id, raw_key[7:] AS prd_key
FROM (SELECT p_partkey,
        CASE WHEN p_partkey % 13 = 0 THEN 'AB' WHEN p_partkey % 17 = 0 THEN NULL
             ELSE upper(substring(p_type, 1, 2)) || '-' || lpad(substring(p_brand, 7), 2, '0') || '-' || p_name
        END AS raw_key
      FROM part)""",
    "parse_int_dates": f"""
SELECT o_orderkey, int_date, {_int_date_sql('int_date')} AS parsed_date
FROM (SELECT o_orderkey,
        CASE o_orderkey % 10 WHEN 0 THEN 0 WHEN 1 THEN d // 1000 WHEN 2 THEN d + 1200 WHEN 3 THEN NULL
             WHEN 4 THEN -(d // 10) WHEN 5 THEN 20230229 WHEN 6 THEN d * 10 WHEN 7 THEN 20240229
             ELSE d END AS int_date
      FROM (SELECT o_orderkey,
              CAST(year(o_orderdate) * 10000 + month(o_orderdate) * 100 + day(o_orderdate) AS BIGINT) AS d
            FROM orders))""",
    "repair_sales": """
WITH amounts AS (
  SELECT l_orderkey, l_linenumber, (l_orderkey * 7 + l_linenumber) % 14 AS m,
    CAST(l_quantity AS BIGINT) AS q, CAST(floor(l_extendedprice / l_quantity) AS BIGINT) AS p
  FROM lineitem
), spoiled AS (
  SELECT l_orderkey, l_linenumber,
    CASE WHEN m IN (1, 6, 12) THEN NULL WHEN m = 2 THEN 0 WHEN m IN (3, 13) THEN -(q * p)
         WHEN m = 4 THEN q * p + 1 ELSE q * p END AS raw_sales,
    CASE WHEN m IN (9, 10) THEN 0 WHEN m = 11 THEN NULL ELSE q END AS sls_quantity,
    CASE WHEN m IN (5, 6, 10, 13) THEN NULL WHEN m = 7 THEN 0 WHEN m IN (8, 12) THEN -p ELSE p END AS raw_price
  FROM amounts
)
SELECT l_orderkey, l_linenumber, raw_sales, sls_quantity, raw_price,
  if(raw_sales > 0 AND coalesce(raw_sales = expected, TRUE), raw_sales, expected) AS sls_sales,
  if(raw_price > 0, raw_price, raw_sales / nullif(sls_quantity, 0)) AS sls_price
FROM (SELECT *, abs(raw_price) * sls_quantity AS expected FROM spoiled)""",
    "strip_prefix_ids": """
SELECT c_custkey, cid_raw, CASE WHEN cid_raw LIKE 'NAS%' THEN substring(cid_raw, 4) ELSE cid_raw END AS cid
FROM (SELECT c_custkey, CASE c_custkey % 4 WHEN 0 THEN 'NAS' || c_name WHEN 1 THEN 'nas' || c_name
                             WHEN 2 THEN 'NAS' ELSE c_name END AS cid_raw FROM customer)""",
    "try_cast_dates": f"""
SELECT o_orderkey, date_raw, TRY_CAST(date_raw AS DATE) AS parsed_date
FROM (SELECT o_orderkey, {DATE_STRINGS} AS date_raw FROM orders)""",
    "null_future_dates": f"""
SELECT o_orderkey, bdate_raw,
  CASE WHEN TRY_CAST(bdate_raw AS DATE) > DATE '1998-01-01' THEN NULL ELSE TRY_CAST(bdate_raw AS DATE) END AS bdate
FROM (SELECT o_orderkey, {DATE_STRINGS} AS bdate_raw FROM orders)""",
    "strip_dashes": """
SELECT o_orderkey, o_orderpriority, replace(o_orderpriority, '-', '') AS priority_code FROM orders""",
    "missing_flag": f"""
SELECT c_custkey, coalesce(f, 'n/a') AS first_name, coalesce(l, 'n/a') AS last_name,
  f IS NULL OR l IS NULL AS dq_missing_name_flag
FROM (SELECT c_custkey, {title_sql('first_raw')} AS f, {title_sql('last_raw')} AS l
      FROM (SELECT c_custkey, CASE c_custkey % 5 WHEN 0 THEN '' WHEN 1 THEN NULL ELSE c_name END AS first_raw,
              CASE c_custkey % 7 WHEN 0 THEN '  ' ELSE c_mktsegment END AS last_raw
            FROM customer))""",
    "gender_fallback": f"""
SELECT c_custkey, crm_gender, erp_gender,
  list_filter([nullif(crm_gender, 'n/a'), erp_gender, 'n/a'], lambda g: g IS NOT NULL)[1] AS gender
FROM ({GENDERS})""",
    "gender_fallback_intended": f"""
SELECT c_custkey, crm_gender, erp_gender,
  list_filter([nullif(nullif(crm_gender, 'n/a'), 'Unknown'), erp_gender, 'n/a'], lambda g: g IS NOT NULL)[1] AS gender
FROM ({GENDERS})""",
    "pass_through": "SELECT * FROM region",
    "cast_rounding": """
SELECT event_id, amount, CAST(amount AS BIGINT) AS amount_long
FROM (SELECT event_id, CASE WHEN event_id % 2 = 0 THEN CAST(0 AS DOUBLE) - floor(value * 4) / 2 ELSE floor(value * 4) / 2 END
             AS amount FROM events)""",
    "dense_key_distributed": """
SELECT o_orderkey, o_custkey, order_date,
  row_number() OVER (ORDER BY order_date NULLS LAST, o_custkey NULLS LAST, o_orderkey NULLS LAST) AS order_sk
FROM (SELECT o_orderkey, o_custkey, CAST(o_orderdate AS DATE) AS order_date FROM orders)""",
    "silver_cust_info": _dataset("silver_cust_info", ["bronze_cust_info", "silver_cust_info"]),
    "silver_prd_info": _dataset("silver_prd_info", ["bronze_prd_info", "versions", "silver_prd_info"]),
    "silver_sales_details": _dataset("silver_sales_details", ["bronze_sales_details", "silver_sales_details"]),
    "silver_cust_az12": _dataset("silver_cust_az12", ["bronze_cust_az12", "silver_cust_az12"]),
    "silver_loc_a101": _dataset("silver_loc_a101", ["bronze_loc_a101", "located", "silver_loc_a101"]),
    "silver_px_cat_g1v2": _dataset("silver_px_cat_g1v2", ["bronze_px_cat_g1v2", "silver_px_cat_g1v2"]),
    "gold_dim_customers": _dataset("gold_dim_customers", [*CUSTOMER_CHAIN, "gold_dim_customers"]),
    "gold_dim_customers_intended": _dataset(
        "gold_dim_customers_intended", [*CUSTOMER_CHAIN, "gold_dim_customers_intended"]
    ),
    "gold_dim_products": _dataset("gold_dim_products", [*PRODUCT_CHAIN, "gold_dim_products"]),
    "gold_fact_sales": _dataset("gold_fact_sales", FACT_CHAIN),
    "gold_fact_sales_history": _dataset(
        "gold_fact_sales_history", [*[c for c in FACT_CHAIN if c not in ("gold_fact_sales", "gold_dim_products")], "product_versions", "gold_fact_sales_history"]
    ),
    "rule_violations": _with(["bronze_sales_details", "silver_sales_details"], _rules_sql("silver_sales_details", RULES)),
    "publish_gate": _with(
        ["bronze_sales_details", "silver_sales_details"],
        f"""SELECT attempt, rule, violations, unknown, checked, attempt = 'kept' AS published, day_rows, day_sales
FROM (
  SELECT 'kept' AS attempt, * FROM ({_rules_sql("silver_sales_details", RULES)})
  UNION ALL
  SELECT 'refused', * FROM ({_rules_sql(
            "(SELECT * REPLACE (sls_sales + CASE WHEN sls_quantity > 25 THEN 1 ELSE 0 END AS sls_sales) FROM silver_sales_details)",
            dict([*RULES.items()][:1]),
        )})),
  (SELECT count(*) AS day_rows, CAST(sum(sls_sales) AS BIGINT) AS day_sales FROM silver_sales_details)""",
    ),
    "fact_rule_violations": _with(FACT_CHAIN, _rules_sql("gold_fact_sales", FACT_RULES)),
    "duplicated_customer_keys": _with(
        [*CUSTOMER_CHAIN, "gold_dim_customers"],
        "SELECT customer_id, count(*) AS copies FROM gold_dim_customers GROUP BY customer_id HAVING count(*) > 1",
    ),
    "unmatched_categories": _with(
        [*PRODUCT_CHAIN, "gold_dim_products"],
        "SELECT category_id, count(*) AS products FROM gold_dim_products WHERE category IS NULL GROUP BY category_id",
    ),
    "fact_fanout": _with(
        FACT_CHAIN,
        """SELECT f.order_number, f.fact_lines, s.sales_lines
FROM (SELECT order_number, count(*) AS fact_lines FROM gold_fact_sales GROUP BY order_number) f
LEFT JOIN (SELECT sls_ord_num, count(*) AS sales_lines FROM silver_sales_details GROUP BY sls_ord_num) s
  ON f.order_number = s.sls_ord_num
WHERE f.fact_lines > coalesce(s.sales_lines, 0)""",
    ),
    "layer_counts": _with(
        ALL_SILVER,
        "\nUNION ALL\n".join(
            f"SELECT '{dataset}' AS dataset, CAST(count(*) AS BIGINT) AS row_count FROM {cte}"
            for dataset, cte in SILVER_DATASETS.items()
        ),
    ),
    "csv_ingest_roundtrip": f"""
SELECT p_partkey,
  CASE WHEN name IN ({NA_LIST}) THEN NULL ELSE name END AS p_name,
  p_brand,
  CASE WHEN p_partkey % 9 = 0 THEN NULL ELSE CAST(p_size AS BIGINT) END AS p_size,
  CASE WHEN p_partkey % 10 < 2 THEN NULL ELSE p_retailprice END AS p_retailprice
FROM (SELECT *, {CSV_NAMES} AS name FROM part)""",
    "csv_type_drift": f"""
WITH cells AS (
  UNPIVOT (
    SELECT CAST(p_partkey AS VARCHAR) AS p_partkey, p_name, 'NA' AS p_brand,
      CASE WHEN p_partkey % 50 = 3 THEN p_size || '.5' ELSE CAST(p_size AS VARCHAR) END AS p_size,
      CASE WHEN p_partkey % 40 = 7 THEN 'on request' WHEN p_partkey % 10 = 1 THEN 'NaN'
           ELSE CAST(p_retailprice AS VARCHAR) END AS p_retailprice
    FROM part
  ) ON COLUMNS(*) INTO NAME "column" VALUE cell
), ranked AS (
  SELECT *, CASE WHEN cell IN ({NA_LIST}) THEN 0 WHEN regexp_full_match(cell, '[+-]?[0-9]+') THEN 1
                 WHEN TRY_CAST(cell AS DOUBLE) IS NOT NULL THEN 2 ELSE 3 END AS n,
    CASE WHEN "column" IN ('p_partkey', 'p_size') THEN 1 WHEN "column" = 'p_retailprice' THEN 2 ELSE 3 END AS d
  FROM cells
)
SELECT "column", ['NONE', 'LONG', 'DOUBLE', 'TEXT'][any_value(d) + 1] AS declared,
  ['NONE', 'LONG', 'DOUBLE', 'TEXT'][max(n) + 1] AS needed,
  count(*) FILTER (n > 0) AS values, count(*) FILTER (n > d) AS misfits
FROM ranked GROUP BY "column"
""",
    "partition_overwrite": """
SELECT r_regionkey, r_name, '2026-01-01' AS ingest_date FROM region
UNION ALL
SELECT r_regionkey, lower(r_name), '2026-01-02' AS ingest_date FROM region""",
    "partition_overwrite_manifest": "SELECT *, CAST(0 AS BIGINT) AS unpublished_rows FROM orders",
    "partition_overwrite_empty": "SELECT *, '2026-01-01' AS ingest_date FROM orders",
    "pass_through_orders": "SELECT * FROM orders",
    "gold_fact_sales_merge_joined": _dataset("gold_fact_sales", FACT_CHAIN),
    "pipeline_from_csv": _dataset("gold_fact_sales", FACT_CHAIN),
}
