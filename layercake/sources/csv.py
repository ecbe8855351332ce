"""CSV ingest with the bronze layer's parsing rules."""

from __future__ import annotations

import csv
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from layercake.sources.catalog import DatasetSpec
from layercake.sources.csv_records import csv_records, field_count

# Fixed values. Cell contents read as missing (exact, case-sensitive matches;
# surrounding whitespace makes a value non-missing). This is the default NA set
# of the dataframe CSV reader the bronze layer was first defined with.
NA_TOKENS = (
    "",
    "#N/A",
    "#N/A N/A",
    "#NA",
    "-1.#IND",
    "-1.#QNAN",
    "-NaN",
    "-nan",
    "1.#IND",
    "1.#QNAN",
    "<NA>",
    "N/A",
    "NA",
    "NULL",
    "NaN",
    "None",
    "n/a",
    "nan",
    "null",
)

#: Columns of ``read_csv_text`` that say where a row comes from.
FILE, LINE = "__lc_file", "__lc_line"

_CSV_OPTIONS = {
    "quote": '"',
    "escape": '"',
    "mode": "PERMISSIVE",
    "ignoreLeadingWhiteSpace": "false",
    "ignoreTrailingWhiteSpace": "false",
}


def null_na_tokens(c: Column) -> Column:
    return F.when(c.isin(list(NA_TOKENS)), F.lit(None).cast("string")).otherwise(c)


def _hidden(file: str, root: str) -> bool:
    """Whether a part of the path below ``root`` begins with '_' or '.': files that are
    not yet published, or no data."""
    return any(part.startswith(("_", ".")) for part in file[len(root) :].split("/"))


def _source_files(spark: SparkSession, path: str, spec: DatasetSpec) -> list[str]:
    """Data files under ``path`` (a file, folder or glob), in a fixed order."""
    jvm = spark._jvm
    place = jvm.org.apache.hadoop.fs.Path(path)
    system = place.getFileSystem(spark._jsc.hadoopConfiguration())
    found = system.globStatus(place)
    if not found:
        raise FileNotFoundError(f"{spec.qualified}: source file not found: {path}")
    files = []
    for status in found:
        root = status.getPath().toString()
        listing = system.listFiles(status.getPath(), True)
        while listing.hasNext():
            file = listing.next()
            name = file.getPath().toString()
            if file.getLen() and not _hidden(name, root):
                files.append(name)
    return sorted(files)


def _header(spark: SparkSession, file: str) -> tuple[str, ...]:
    """Column names in the first line of ``file`` (read on the driver, decompressed)."""
    jvm = spark._jvm
    conf = spark._jsc.hadoopConfiguration()
    place = jvm.org.apache.hadoop.fs.Path(file)
    stream = place.getFileSystem(conf).open(place)
    try:
        codec = jvm.org.apache.hadoop.io.compress.CompressionCodecFactory(conf).getCodec(place)
        content = codec.createInputStream(stream) if codec else stream
        line = jvm.java.io.BufferedReader(jvm.java.io.InputStreamReader(content, "UTF-8")).readLine()
    finally:
        stream.close()
    return tuple(next(csv.reader([line.removeprefix("\ufeff")]), []))


def _read_lines(spark: SparkSession, files: list[str], header: tuple[str, ...]) -> DataFrame:
    """Files in which every line is a record, by Spark's own reader."""
    return (
        spark.read.schema(T.StructType([T.StructField(h, T.StringType(), True) for h in header]))
        .option("header", True)
        .options(**_CSV_OPTIONS)
        .option("maxColumns", len(header))
        .csv(files)
        .withColumns({FILE: F.col("_metadata.file_path"), LINE: F.lit(None).cast("bigint")})
    )


def _parse_records(records: DataFrame, header: tuple[str, ...], spec: DatasetSpec) -> DataFrame:
    """String columns of records whose files have this header; a record with more fields
    than columns fails, whichever columns are read."""
    n = len(header)
    message = F.concat(F.lit(f"{spec.qualified}: more fields than the {n} columns of the header: "), F.col("path"), F.lit(" line "), F.col("line").cast("string"), F.lit(": "), F.left("record", F.lit(200)))
    # a record with fewer delimiters than columns needs no parsing to be judged
    delimiters = F.length("record") - F.length(F.replace(F.col("record"), F.lit(","), F.lit("")))
    too_long = (delimiters >= n) & (field_count(F.col("record")) > n)
    checked = records.where(F.when(too_long, F.raise_error(message).cast("boolean")).otherwise(F.lit(True)))
    values = F.from_csv("record", ", ".join(f"_c{i} string" for i in range(n)), {**_CSV_OPTIONS, "multiLine": "true", "maxColumns": str(n + 1)})
    return checked.select("path", "line", values.alias("v")).select(*[F.col(f"v._c{i}").alias(h) for i, h in enumerate(header)], F.col("path").alias(FILE), F.col("line").alias(LINE))


def read_csv_source(
    spark: SparkSession,
    path: str,
    spec: DatasetSpec,
    *,
    multi_line: bool | None = None,
) -> DataFrame:
    """Read one source CSV (a file or a folder of files) into the typed bronze schema of
    ``spec``.

    * a missing path raises ``FileNotFoundError`` naming the dataset;
    * header names are matched to the schema case-insensitively and for every file by
      itself, so files may order their columns differently; a missing column raises
      ``ValueError``; the output uses the first file's spelling;
    * ``""`` inside quotes is an escaped quote; quoted values may hold newlines;
    * cells equal to one of ``NA_TOKENS`` become NULL, in every column, before
      the cast to the declared type (a malformed number raises under ANSI);
    * short rows are padded with NULLs; a row with *more* fields than its file's header
      fails the job, empty fields included, whichever columns are selected, and the error
      names the dataset, file and line;
    * leading/trailing spaces are kept;
    * files below a hidden folder (``_temporary``, ``.staging``) are not read.

    Every file is read in parallel splits, wherever its quotes are (see ``csv_records``).
    ``multi_line=False`` vouches for values without newlines: then the lines are parsed as
    they are read, without the written copy that resolving the splits needs.
    """
    text = read_csv_text(spark, path, spec, multi_line=multi_line)
    names = [c for c in text.columns if c not in (FILE, LINE)]
    return text.select(*[F.col(f"`{c}`").cast(f.dataType).alias(c) for c, f in zip(names, spec.schema.fields, strict=True)])


def read_csv_text(spark: SparkSession, path: str, spec: DatasetSpec, *, multi_line: bool | None = None) -> DataFrame:
    """The columns of ``spec`` as text, missing-value tokens NULL, and where each row comes
    from: ``FILE`` and ``LINE`` (NULL with ``multi_line=False``). See ``read_csv_source``."""
    files = _source_files(spark, path, spec)
    by_header: dict[tuple[str, ...], list[str]] = {}
    for file in files:
        by_header.setdefault(_header(spark, file), []).append(file)
    if not by_header:
        raise ValueError(f"{spec.qualified}: no header in {path}")
    for header, own in by_header.items():
        lower = {h.lower() for h in header}
        missing = [f.name for f in spec.schema.fields if f.name.lower() not in lower]
        if missing:
            raise ValueError(f"{spec.qualified}: columns {missing} not in CSV header {list(header)} ({own[0]})")
    records = csv_records(spark, files, spec.qualified) if multi_line is not False else None
    spelling: dict[str, str] = {}
    frames = []
    for header, own in by_header.items():
        by_lower = {h.lower(): h for h in header}
        spelling = spelling or by_lower
        if records is None:
            raw = _read_lines(spark, own, header)
        else:
            mine = records if len(by_header) == 1 else records.where(F.col("path").isin(own))
            raw = _parse_records(mine, header, spec)
        cols = [
            null_na_tokens(F.col(f"`{by_lower[f.name.lower()]}`")).alias(spelling[f.name.lower()])
            for f in spec.schema.fields
        ]
        frames.append(raw.select(*cols, FILE, LINE))
    return reduce(DataFrame.unionByName, frames)
