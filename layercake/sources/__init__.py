"""Sources and sinks: dataset catalog, CSV ingest, layer layout, Parquet IO."""

from layercake.sources.catalog import SOURCE_CATALOG, DatasetSpec, all_datasets, dataset
from layercake.sources.csv import NA_TOKENS, read_csv_source
from layercake.sources.drift import TypeDriftError, check_types, type_drift
from layercake.sources.layers import (
    PARTITION_COLUMN,
    layer_path,
    object_store_conf,
    object_store_conf_from_env,
    publish_layer,
    read_layer,
    resolve_base,
    write_layer,
)
from layercake.sources.partition import resolve_partition_date
from layercake.sources.publish import Gate, Published, QualityGateError, publish

__all__ = [
    "NA_TOKENS",
    "PARTITION_COLUMN",
    "Published",
    "QualityGateError",
    "SOURCE_CATALOG",
    "DatasetSpec",
    "Gate",
    "TypeDriftError",
    "all_datasets",
    "check_types",
    "dataset",
    "layer_path",
    "object_store_conf",
    "object_store_conf_from_env",
    "publish",
    "publish_layer",
    "read_csv_source",
    "read_layer",
    "resolve_base",
    "resolve_partition_date",
    "type_drift",
    "write_layer",
]
