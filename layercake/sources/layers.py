"""Layer layout and Parquet read/write.

Layout (bronze and silver carry the source, gold does not)::

    <base>/bronze/<source>/<dataset>/ingest_date=YYYY-MM-DD/part-*.parquet
    <base>/silver/<source>/<dataset>/ingest_date=YYYY-MM-DD/part-*.parquet
    <base>/gold/<dataset>/ingest_date=YYYY-MM-DD/part-*.parquet

``base`` is any Hadoop URI (``file:``, ``s3a://bucket``...). The partition folder is
named like a Hive partition, so that a whole dataset reads as one partitioned table.
"""

from __future__ import annotations

import os

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession

from layercake.sources.publish import Gate, Published, publish, published_location

LAYERS = ("bronze", "silver", "gold")
PARTITION_COLUMN = "ingest_date"

# Environment of the object-store deployment (endpoint, bucket,
# credentials), its region, and the local base used when no bucket is named.
STORE_ENDPOINT_ENV = "MINIO_ENDPOINT"
STORE_BUCKET_ENV = "MINIO_BUCKET"
STORE_ACCESS_KEY_ENV = "MINIO_ACCESS_KEY"
STORE_SECRET_KEY_ENV = "MINIO_SECRET_KEY"
STORE_REGION = "us-east-1"
LOCAL_BASE = "data"

# Settings of the committer for ``s3a`` paths (classes of Spark's hadoop-cloud module, which
# such a deployment has on its class path). Other schemes keep their committer.
RENAME_FREE_COMMITTER = {
    "spark.hadoop.mapreduce.outputcommitter.factory.scheme.s3a": "org.apache.hadoop.fs.s3a.commit.S3ACommitterFactory",
    "spark.hadoop.fs.s3a.committer.name": "magic",
    "spark.hadoop.fs.s3a.committer.magic.enabled": "true",
    "spark.sql.sources.commitProtocolClass": "org.apache.spark.internal.io.cloud.PathOutputCommitProtocol",
    "spark.sql.parquet.output.committer.class": "org.apache.spark.internal.io.cloud.BindingParquetOutputCommitter",
}


def layer_path(base: str, layer: str, dataset: str, source: str | None = None) -> str:
    if layer not in LAYERS:
        raise ValueError(f"unknown layer {layer!r}; expected one of {LAYERS}")
    parts = [base.rstrip("/"), layer, *([source] if source else []), dataset]
    return "/".join(parts)


def partition_path(root: str, date: str) -> str:
    return f"{root}/{PARTITION_COLUMN}={date}"


def read_layer(
    spark: SparkSession,
    base: str,
    layer: str,
    dataset: str,
    date: str,
    source: str | None = None,
) -> DataFrame:
    """Read the published rows of one day of a layer dataset (see ``publish``); a missing
    input raises ``FileNotFoundError`` naming the layer and path (any URI scheme)."""
    root = layer_path(base, layer, dataset, source)
    path = partition_path(root, date)
    folder, files = published_location(spark, path)
    try:
        df = spark.read.option("basePath", root if folder == path else folder).parquet(*(files or [folder]))
    except AnalysisException as exc:
        if "PATH_NOT_FOUND" in str(exc) or "Path does not exist" in str(exc):
            raise FileNotFoundError(f"{layer} input not found: {path}") from exc
        raise
    return df.drop(PARTITION_COLUMN)


def publish_layer(
    df: DataFrame,
    base: str,
    layer: str,
    dataset: str,
    date: str,
    source: str | None = None,
    *,
    gate: Gate | None = None,
    protocol: str | None = None,
) -> Published:
    """Replace one day of a layer dataset: rows written, counts of the gate's rules, files.

    Other days are untouched, a re-run replaces the day (idempotent), and a day without rows
    becomes an empty table with its schema. Until the new rows are complete and have passed
    the gate, the old day stays as it was, whenever the job ends (see ``publish``).
    """
    path = partition_path(layer_path(base, layer, dataset, source), date)
    label = ".".join(filter(None, (layer, source, dataset, date)))
    return publish(df.drop(PARTITION_COLUMN), path, gate=gate, protocol=protocol, label=label)


def write_layer(
    df: DataFrame,
    base: str,
    layer: str,
    dataset: str,
    date: str,
    source: str | None = None,
    *,
    gate: Gate | None = None,
) -> int:
    """``publish_layer``; returns the rows written."""
    return publish_layer(df, base, layer, dataset, date, source, gate=gate).rows


def object_store_conf(
    endpoint: str,
    access_key: str,
    secret_key: str,
    *,
    region: str | None = None,
    ssl: bool = False,
    path_style: bool = True,
) -> dict[str, str]:
    """Session settings for an S3-compatible store used through ``s3a://`` paths.

    Writes go through the magic committer: tasks upload their files in parts, and the job's
    commit completes the uploads, so that nothing is renamed (a rename is a copy there).
    """
    conf = {
        "spark.hadoop.fs.s3a.endpoint": endpoint,
        "spark.hadoop.fs.s3a.access.key": access_key,
        "spark.hadoop.fs.s3a.secret.key": secret_key,
        "spark.hadoop.fs.s3a.connection.ssl.enabled": str(ssl).lower(),
        "spark.hadoop.fs.s3a.path.style.access": str(path_style).lower(),
        **RENAME_FREE_COMMITTER,
    }
    if region:
        conf["spark.hadoop.fs.s3a.endpoint.region"] = region
    return conf


def resolve_base(explicit: str | None = None) -> str:
    """Lake root: explicit argument, else ``s3a://<bucket>`` when the bucket
    variable is set, else the local ``data`` folder."""
    if explicit:
        return explicit
    bucket = os.environ.get(STORE_BUCKET_ENV)
    return f"s3a://{bucket}" if bucket else LOCAL_BASE


def object_store_conf_from_env() -> dict[str, str]:
    """``object_store_conf`` from the deployment's environment (empty when no
    endpoint is configured): path-style access, no TLS, fixed region."""
    endpoint = os.environ.get(STORE_ENDPOINT_ENV)
    if not endpoint:
        return {}
    return object_store_conf(
        endpoint,
        os.environ.get(STORE_ACCESS_KEY_ENV, ""),
        os.environ.get(STORE_SECRET_KEY_ENV, ""),
        region=STORE_REGION,
        ssl=False,
        path_style=True,
    )
