"""SparkSession settings shared by jobs, tests and the benchmark."""

from __future__ import annotations

import re
import tempfile
import threading
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

# Settings the results depend on: always applied.
#  * ANSI on: overflow and bad casts raise instead of silently wrapping.
#  * UTC session time zone (dates and zone-less timestamps only are used).
SEMANTIC_CONF: dict[str, str] = {
    "spark.sql.ansi.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
}

# Execution defaults: applied unless the submitted configuration sets them.
#  * dynamic partition overwrite: re-running one ingest date leaves the others intact.
#  * broadcasts are chosen by Spark: statically from the size of the files a side
#    reads (Spark's own threshold), or by AQE from the real shuffle sizes.
#  * AQE with skew-join splitting for hot join keys.
#  * generated methods kept under HotSpot's JIT limit (8000 bytes of bytecode):
#    larger stages fall back to per-operator code instead of running interpreted.
BASE_CONF: dict[str, str] = {
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.autoBroadcastJoinThreshold": "32MB",
    "spark.sql.parquet.compression.codec": "zstd",
    "spark.sql.codegen.hugeMethodLimit": "8000",
    "spark.ui.enabled": "false",
}

# Cluster-sized shuffle defaults for the jobs: many initial shuffle partitions
# that AQE coalesces to ~128 MB each, so a partition fits an executor whatever
# the day's volume; input splits of 256 MB.
CLUSTER_CONF: dict[str, str] = {
    "spark.sql.adaptive.coalescePartitions.initialPartitionNum": "4096",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "128MB",
    "spark.sql.files.maxPartitionBytes": "256MB",
}


def build_session(
    master: str | None = None,
    app_name: str = "layercake",
    shuffle_partitions: int | None = None,
    extra: dict[str, str] | None = None,
) -> SparkSession:
    """Create (or return) a session with the engine's settings.

    Semantic settings are always applied; execution defaults (``BASE_CONF`` and
    ``extra``) only where the submitted configuration (``spark-submit --conf``,
    ``spark-defaults.conf``) does not already set the key.
    """
    from pyspark import SparkConf

    submitted = SparkConf()
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    defaults = dict(BASE_CONF)
    if shuffle_partitions:
        defaults["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    defaults.update(extra or {})
    for key, value in defaults.items():
        if not submitted.contains(key):
            builder = builder.config(key, value)
    for key, value in SEMANTIC_CONF.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def checkpoint_dir(spark: SparkSession) -> str:
    """The shared checkpoint folder of the cluster.

    Read from the session (``spark.checkpoint.dir`` / ``SparkContext``). Where nothing
    is configured, a local run gets a private folder; on a cluster that would be a
    folder of one machine, so it is a ``ValueError`` there.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir() or spark.conf.get("spark.checkpoint.dir", None)
    if not current:
        if not re.fullmatch(r"local(\[.*\])?", sc.master):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        current = tempfile.mkdtemp(prefix="layercake-ckpt-")
        sc.setCheckpointDir(current)
    elif not sc.getCheckpointDir():
        sc.setCheckpointDir(current)
    return sc.getCheckpointDir() or current


_SCOPE = threading.local()


def _scratch_root(spark: SparkSession) -> str:
    """The application's folder for intermediate tables, deleted when it ends."""
    sc = spark.sparkContext
    path = f"{checkpoint_dir(spark).rstrip('/')}/scratch-{sc.applicationId}"
    if path not in _ROOTS:
        jvm_path = spark._jvm.org.apache.hadoop.fs.Path(path)
        file_system = jvm_path.getFileSystem(spark._jsc.hadoopConfiguration())
        file_system.mkdirs(jvm_path)
        file_system.deleteOnExit(jvm_path)
        _ROOTS.add(path)
    return path


_ROOTS: set[str] = set()


def scratch_dir(spark: SparkSession, label: str) -> str:
    """A fresh path under the shared checkpoint folder for an intermediate table
    (registered with the enclosing ``scratch_scope`` of this thread, if any). It is
    deleted at the latest when the application ends."""
    path = f"{_scratch_root(spark)}/{label}-{uuid.uuid4().hex}"
    created = getattr(_SCOPE, "paths", None)
    if created is not None:
        created.append(path)
    return path


def _delete(spark: SparkSession, path: str) -> None:
    jvm_path = spark._jvm.org.apache.hadoop.fs.Path(path)
    jvm_path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(jvm_path, True)


@contextmanager
def scratch_scope(spark: SparkSession) -> Iterator[list[str]]:
    """Delete the scratch tables created by this thread inside the block when it
    ends. Use it around work whose result is already written (a layer step);
    DataFrames still reading a scratch table must not outlive the block."""
    outer = getattr(_SCOPE, "paths", None)
    created: list[str] = []
    _SCOPE.paths = created
    try:
        yield created
    finally:
        _SCOPE.paths = outer
        for path in created:
            _delete(spark, path)


def write_scratch(df: DataFrame, label: str) -> DataFrame:
    """Write ``df`` as Parquet under the shared scratch folder and read it back:
    the plan runs once, later passes read columnar data (row counts come from
    file metadata) and never re-run the lineage."""
    spark = df.sparkSession
    path = scratch_dir(spark, label)
    df.write.mode("overwrite").parquet(path)
    return spark.read.parquet(path)


@contextmanager
def shuffles_freed(spark: SparkSession) -> Iterator[None]:
    """Spark deletes the shuffle files of every query that ends inside the block, instead of
    when the driver happens to collect its garbage: for passes whose result is written and
    whose shuffles take as much disk as the input. Files that are needed again are made again."""
    setting = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before = spark.conf.get(setting, None)
    spark.conf.set(setting, "true")
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(setting)
        else:
            spark.conf.set(setting, before)
