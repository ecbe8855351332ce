"""Records of CSV files whose quoted values may hold newlines, read in parallel splits.

Where a record begins depends on every quote before it in its file, which a split cannot
see. So each split marks its lines for both cases, that it begins outside or inside a
quoted value, in one streaming pass, and the marked lines are written. One small row per
split (what each case comes to at its end) reaches the driver, where a running state over
the splits of each file tells which case held. From then on it is plain DataFrame work: a
line that is a whole record is one as it stands, and only the lines of records with
newlines are grouped. A file is scanned once.
"""

from __future__ import annotations

import re
from collections.abc import Iterable, Iterator, Sequence
from itertools import groupby

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from layercake.session import write_scratch

_MARKED = "file long, block long, n long, line binary, in0 boolean, in1 boolean, out0 boolean, out1 boolean, rec0 long, rec1 long"
#: The rest of a quoted value after its opening quote, with the closing one.
_QUOTED = re.compile(rb'[^"]*+(?:""[^"]*+)*+"')
#: One field and the delimiter after it; values with newlines too.
_FIELD = r'(?s)(?:"[^"]*+(?:""[^"]*+)*+"[^,]*+|[^,]*+),'


def ends_inside(line: bytes, inside: bool) -> bool:
    """Whether a line that begins outside or inside a quoted value ends inside one. A
    quote opens a value only as its first character; after the closing quote the value
    goes on, unquoted, to the next delimiter."""
    at = 0
    while True:
        if not inside:
            if line[at : at + 1] == b'"':
                at += 1
            else:
                at = line.find(b',"', at) + 2
                if at == 1:
                    return False
        closed = _QUOTED.match(line, at)
        if not closed:
            return True
        at, inside = line.find(b",", closed.end()) + 1, False
        if at == 0:
            return False


def _states(out_of_0: np.ndarray, out_of_1: np.ndarray, first: bool) -> tuple[np.ndarray, np.ndarray]:
    """States (inside a quoted value) before and after each line, from what each line makes
    of either state and the state before the first: the last line that ends alike in both
    cases decides, and lines that invert the state since."""
    inverted = np.cumsum(out_of_0 & ~out_of_1)
    decided = np.maximum.accumulate(np.where(out_of_0 == out_of_1, np.arange(len(out_of_0)), -1))
    since = inverted - np.where(decided >= 0, inverted[decided], 0)
    after = np.where(decided >= 0, out_of_0[decided], first) ^ (since % 2 == 1)
    return np.append(first, after[:-1]), after


def _mark_lines(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The lines of whole splits in order, marked for both cases."""
    split, n, state, begun = None, 0, [False, True], [0, 0]
    for batch in batches:
        files, blocks = (batch.column(i).to_numpy() for i in (0, 1))
        cuts = np.flatnonzero((np.diff(files) != 0) | (np.diff(blocks) != 0)) + 1
        for a, b in zip([0, *cuts], [*cuts, batch.num_rows], strict=True):
            if a == b:
                continue
            if (files[a], blocks[a]) != split:
                split, n, state, begun = (files[a], blocks[a]), 0, [False, True], [0, 0]
            lines = batch.column(2).slice(a, b - a)
            out_of = [np.zeros(b - a, bool), np.ones(b - a, bool)]
            for i in np.flatnonzero(pc.count_substring(lines, '"').to_numpy()):
                line = lines[int(i)].as_py()
                out_of[0][i], out_of[1][i] = ends_inside(line, False), ends_inside(line, True)
            marks, records = [], []
            for case in (0, 1):
                before, after = _states(*out_of, state[case])
                marks += [before, after]
                records.append(begun[case] + np.cumsum(~before))
                state[case], begun[case] = bool(after[-1]), int(records[-1][-1])
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0).slice(a, b - a),
                    batch.column(1).slice(a, b - a),
                    pa.array(np.arange(n, n + b - a)),
                    lines,
                    *[pa.array(marks[i]) for i in (0, 2, 1, 3)],
                    *[pa.array(r.astype(np.int64)) for r in records],
                ],
                ["file", "block", "n", "line", "in0", "in1", "out0", "out1", "rec0", "rec1"],
            )
            n += b - a


def _splits(spark: SparkSession, lines: DataFrame) -> tuple[DataFrame, list[str]]:
    """One row per split: which case holds, the lines before it in its file, and the record
    that its first lines may continue; and the files that end inside a quoted value."""
    last = F.max_by(F.struct("out0", "out1", "rec0", "rec1"), "n").alias("last")
    found = lines.groupBy("file", "block").agg(F.max("path").alias("path"), (F.max("n") + 1).alias("lines"), last).orderBy("file", "block").collect()
    rows, unclosed = [], []
    for _, own in groupby(found, key=lambda r: r["file"]):
        inside, before, open_block, open_rec, path = False, 0, 0, 0, None
        for r in own:
            path = r["path"]
            rows.append((r["file"], r["block"], path, inside, before, open_block, open_rec))
            case = "1" if inside else "0"
            inside, begun = r["last"]["out" + case], r["last"]["rec" + case]
            if begun:
                open_block, open_rec = r["block"], begun
            before += r["lines"]
        if inside:
            unclosed.append(path)
    schema = "s_file long, s_block long, path string, inside boolean, before long, open_block long, open_rec long"
    return spark.createDataFrame(rows, schema), unclosed


def csv_records(spark: SparkSession, files: Sequence[str], label: str) -> DataFrame:
    """The records of ``files`` but for each file's first line: ``path``, ``line`` (its first
    line in the file, from 1) and ``record`` (text without the line end). Blank records are left out. Lines end with a newline, with or without a
    carriage return. A file that ends inside a quoted value raises ``ValueError``.
    """
    encoded = [(spark._jvm.org.apache.hadoop.fs.Path(f).toUri().toString(), f) for f in files]
    names = spark.createDataFrame(encoded, "uri string, path string").select(F.xxhash64("uri").alias("p_file"), "path")
    raw = spark.read.option("lineSep", "\n").text(list(files))
    source = raw.select(F.xxhash64("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block"), F.col("value").cast("binary").alias("line"))
    lines = write_scratch(source.mapInArrow(_mark_lines, _MARKED), "csv-lines")
    by_file = lines.select("file", "block", "n", "out0", "out1", "rec0", "rec1").join(names, F.col("file") == F.col("p_file"), "left")
    splits, unclosed = _splits(spark, by_file)
    if unclosed:
        raise ValueError(f"{label}: a quoted value is not closed at the end of {', '.join(unclosed)}")

    def held(c: str) -> Column:
        return F.when(F.col("inside"), F.col(f"{c}1")).otherwise(F.col(f"{c}0"))

    marked = lines.join(splits, (F.col("file") == F.col("s_file")) & (F.col("block") == F.col("s_block"))).where("block <> 0 OR n <> 0")
    text = F.col("line").cast("string")
    marked = marked.select("path", "file", "block", "n", (F.col("before") + F.col("n") + 1).alias("line"), text.alias("text"), held("in").alias("begins"), held("out").alias("ends"), held("rec").alias("rec"), "open_block", "open_rec")
    whole = marked.where("NOT begins AND NOT ends").select("path", "line", "text")
    parts = marked.where("begins OR ends").withColumn("own", F.col("rec") > 0)
    key = [F.col("file"), F.when(F.col("own"), F.col("block")).otherwise(F.col("open_block")).alias("at"), F.when(F.col("own"), F.col("rec")).otherwise(F.col("open_rec")).alias("which")]
    grouped = parts.groupBy(*key).agg(F.max("path").alias("path"), F.min("line").alias("line"), F.sort_array(F.collect_list(F.struct("block", "n", "text"))).alias("all"))
    longer = grouped.select("path", "line", F.array_join(F.col("all.text"), "\n").alias("text"))
    record = F.when(F.endswith("text", F.lit("\r")), F.expr("left(text, length(text) - 1)")).otherwise(F.col("text"))
    return whole.unionByName(longer).select("path", "line", record.alias("record")).where(F.trim("record") != "")


def field_count(record: Column) -> Column:
    """The number of fields of a record."""
    return F.regexp_count(F.concat(record, F.lit(",")), F.lit(_FIELD))
