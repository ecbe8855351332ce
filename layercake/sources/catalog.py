"""Declarative catalog of the ingested source datasets (two sources x three files)."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import types as T


def _schema(*fields: tuple[str, T.DataType]) -> T.StructType:
    return T.StructType([T.StructField(n, t, True) for n, t in fields])


S, L, D = T.StringType(), T.LongType(), T.DoubleType()


@dataclass(frozen=True)
class DatasetSpec:
    """One source dataset: name, CSV file name and the typed bronze schema.

    Column names are matched case-insensitively against the CSV header.
    Integer columns that may hold blanks are declared with the type the bronze
    layer must keep (ids as DOUBLE where the source has gaps, yyyymmdd dates and
    amounts as LONG).
    """

    source: str
    name: str
    source_file: str
    schema: T.StructType

    @property
    def qualified(self) -> str:
        return f"{self.source}.{self.name}"


SOURCE_CATALOG: dict[str, tuple[DatasetSpec, ...]] = {
    "crm": (
        DatasetSpec(
            "crm",
            "prd_info",
            "prd_info.csv",
            _schema(
                ("prd_id", L), ("prd_key", S), ("prd_nm", S), ("prd_cost", D),
                ("prd_line", S), ("prd_start_dt", S), ("prd_end_dt", S),
            ),
        ),
        DatasetSpec(
            "crm",
            "cust_info",
            "cust_info.csv",
            _schema(
                ("cst_id", D), ("cst_key", S), ("cst_firstname", S), ("cst_lastname", S),
                ("cst_marital_status", S), ("cst_gndr", S), ("cst_create_date", S),
            ),
        ),
        DatasetSpec(
            "crm",
            "sales_details",
            "sales_details.csv",
            _schema(
                ("sls_ord_num", S), ("sls_prd_key", S), ("sls_cust_id", L),
                ("sls_order_dt", L), ("sls_ship_dt", L), ("sls_due_dt", L),
                ("sls_sales", L), ("sls_quantity", L), ("sls_price", L),
            ),
        ),
    ),
    "erp": (
        DatasetSpec(
            "erp",
            "px_cat_g1v2",
            "PX_CAT_G1V2.csv",
            _schema(("ID", S), ("CAT", S), ("SUBCAT", S), ("MAINTENANCE", S)),
        ),
        DatasetSpec(
            "erp",
            "cust_az12",
            "CUST_AZ12.csv",
            _schema(("cid", S), ("bdate", S), ("gen", S)),
        ),
        DatasetSpec(
            "erp",
            "loc_a101",
            "LOC_A101.csv",
            _schema(("cid", S), ("cntry", S)),
        ),
    ),
}


def dataset(source: str, name: str) -> DatasetSpec:
    """Look a dataset up; unknown names raise ``ValueError``."""
    for spec in SOURCE_CATALOG.get(source, ()):
        if spec.name == name:
            return spec
    known = sorted(s.qualified for specs in SOURCE_CATALOG.values() for s in specs)
    raise ValueError(f"unknown dataset {source}.{name}; known: {', '.join(known)}")


def all_datasets() -> list[DatasetSpec]:
    return [s for specs in SOURCE_CATALOG.values() for s in specs]
