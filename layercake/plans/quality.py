"""Data-quality checks of the published layers (one distributed pass each)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from layercake.operators import check_rules, duplicate_keys
from layercake.sources.publish import Gate


def sales_rules() -> dict[str, Column]:
    """Invariants of silver sales lines; the first is the reference's own check."""
    return {
        "sales_equals_quantity_times_price": F.col("sls_sales") == F.col("sls_quantity") * F.abs(F.col("sls_price")),
        "price_positive": F.col("sls_price") > 0,
        "quantity_positive": F.col("sls_quantity") > 0,
        "order_not_after_ship": F.col("sls_order_dt") <= F.col("sls_ship_dt"),
    }


def fact_rules() -> dict[str, Column]:
    """Referential and arithmetic checks of the gold fact."""
    return {
        "product_resolved": F.col("product_key").isNotNull(),
        "customer_resolved": F.col("customer_key").isNotNull(),
        "order_date_present": F.col("order_date").isNotNull(),
        "amount_equals_quantity_times_price": F.col("sales_amount") == F.col("quantity") * F.abs(F.col("price")),
    }


#: Share of the lines that may break a rule by default: the repair reads the source's price,
#: so that a line with a price of zero keeps an amount of zero.
TOLERANCE = 0.1


def sales_gate(tolerance: float = TOLERANCE) -> Gate:
    """What silver sales lines must keep to be published: the amount of every line."""
    name = "sales_equals_quantity_times_price"
    return Gate({name: sales_rules()[name]}, {name: tolerance})


def fact_gate(tolerance: float = TOLERANCE) -> Gate:
    """What the fact must keep to be published: the amount of every line. References may be
    unresolved."""
    name = "amount_equals_quantity_times_price"
    return Gate({name: fact_rules()[name]}, {name: tolerance})


def check_sales(silver_sales: DataFrame) -> DataFrame:
    return check_rules(silver_sales, sales_rules())


def check_fact(fact: DataFrame) -> DataFrame:
    return check_rules(fact, fact_rules())


def duplicated_customers(dim_customers: DataFrame) -> DataFrame:
    """Customer ids present more than once in the dimension (ERP fan-out)."""
    return duplicate_keys(dim_customers, ["customer_id"])


def unmatched_categories(dim_products: DataFrame) -> DataFrame:
    """Category ids of current products without a lookup row, with their counts."""
    return (
        dim_products.where(F.col("category").isNull())
        .groupBy("category_id")
        .agg(F.count(F.lit(1)).alias("products"))
    )


def fact_fanout(silver_sales: DataFrame, fact: DataFrame) -> DataFrame:
    """Orders whose fact has more lines than the sales source (a dimension key
    present more than once multiplies the lines that reference it)."""
    source = silver_sales.groupBy(F.col("sls_ord_num").alias("order_number")).agg(
        F.count(F.lit(1)).alias("sales_lines")
    )
    published = fact.groupBy("order_number").agg(F.count(F.lit(1)).alias("fact_lines"))
    return published.join(source, "order_number", "left").where(
        F.col("fact_lines") > F.coalesce(F.col("sales_lines"), F.lit(0))
    )
