"""Sort specifications and range slices over a composite sort key.

A *range slice* is a contiguous, ordered part of the global sort order. Slicing
by the full sort key (tie-breaks included) splits a hot key or a hot value over
as many tasks as its size needs, which is what lets the per-key and global
ordered operators run without one task holding a whole group.
"""

from __future__ import annotations

from collections.abc import Iterable, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from layercake.session import write_scratch

SLICE = "__lc_slice"
POS = "__lc_pos"
ROW_ID = "__lc_row"


@dataclass(frozen=True)
class Sort:
    """One sort column: direction and where NULLs go (last unless asked)."""

    name: str
    descending: bool = False
    nulls_first: bool = False

    def column(self) -> Column:
        c = F.col(self.name)
        if self.descending:
            return c.desc_nulls_first() if self.nulls_first else c.desc_nulls_last()
        return c.asc_nulls_first() if self.nulls_first else c.asc_nulls_last()


def asc(name: str, nulls_first: bool = False) -> Sort:
    return Sort(name, False, nulls_first)


def desc(name: str, nulls_first: bool = False) -> Sort:
    return Sort(name, True, nulls_first)


def as_sorts(items: Iterable[Sort | str]) -> list[Sort]:
    return [i if isinstance(i, Sort) else Sort(i) for i in items]


_UNORDERABLE = (T.MapType, T.VariantType) if hasattr(T, "VariantType") else (T.MapType,)


def complete_tiebreak(df: DataFrame, sorts: Sequence[Sort]) -> list[Sort]:
    """Append every other orderable column (ascending, NULLs last) so the order
    is total up to fully identical rows, which makes numbering deterministic."""
    used = {s.name.lower() for s in sorts}
    extra = [
        Sort(f.name)
        for f in df.schema.fields
        if f.name.lower() not in used and not isinstance(f.dataType, _UNORDERABLE)
    ]
    return [*sorts, *extra]


#: Setting for the bytes of input files of one slice, and its default: a slice is sorted by
#: one task.
SLICE_BYTES_SETTING = "spark.layercake.sliceBytes"
SLICE_BYTES = 64 << 20
#: Smaller inputs are cut to one slice per core, but not to slices smaller than this.
LEAST_SLICE_BYTES = 1 << 20


def input_bytes(df: DataFrame) -> int | None:
    """Bytes of the files that the plan of ``df`` reads, after the partitions and files that
    its filters leave out, each scan once; None if it reads something else. The sizes come
    from the file listing of the scans: nothing is computed."""
    total = 0
    leaves = df._jdf.queryExecution().optimizedPlan().collectLeaves()
    for i in range(leaves.size()):
        if leaves.apply(i).getClass().getSimpleName() != "LogicalRelation":
            return None
        total += int(str(leaves.apply(i).stats().sizeInBytes()))
    return total if total < 1 << 62 else None


def slices_for(volume: int | None, slice_bytes: int, cores: int, otherwise: int) -> int:
    """Slices for a volume in bytes: as many as keep each to ``slice_bytes``; a small table
    one per core, if that leaves them ``LEAST_SLICE_BYTES``; ``otherwise`` if the volume is
    not known."""
    if volume is None:
        return otherwise
    return max(1, -(-volume // slice_bytes), min(cores, -(-volume // LEAST_SLICE_BYTES)))


def slice_count(df: DataFrame, slices: int | None = None) -> int:
    """Explicit number of slices, else by the volume that the plan reads, else (inputs that
    are no files) as many as the session's shuffle partitions."""
    if slices is not None:
        return max(1, slices)
    spark = df.sparkSession
    size = int(spark.conf.get(SLICE_BYTES_SETTING, str(SLICE_BYTES)))
    return slices_for(input_bytes(df), size, spark.sparkContext.defaultParallelism, int(spark.conf.get("spark.sql.shuffle.partitions")))


def range_slices(df: DataFrame, sorts: Sequence[Sort], slices: int, label: str) -> DataFrame:
    """Cut ``df`` into ``slices`` contiguous ranges of the sort order and write it
    to the shared checkpoint folder.

    The result has two extra columns: ``__lc_slice`` (slice id; every row of slice
    i sorts before every row of slice i+1) and ``__lc_pos`` (0-based position
    inside the slice in sort order). Spark's own range partitioner picks the
    bounds from a sample (about ``spark.sql.execution.rangeExchange
    .sampleSizePerPartition`` sort keys per slice reach the driver, whatever their
    number, so that slices stay even when there are thousands) and places rows
    by binary search, so any number of slices costs the same per row; a slice
    larger than memory is sorted with spilling. A per-row id is the last
    tie-break, so even a group of identical rows holding a third of the table is
    spread over many slices (the order among identical rows is immaterial).
    Writing the table fixes the assignment: every later pass, and every task
    retry, reads the same slices instead of re-sampling.
    """
    order = [s.column() for s in sorts] + [F.col(ROW_ID).asc()]
    sliced = (
        df.withColumn(ROW_ID, F.monotonically_increasing_id())
        .repartitionByRange(slices, *order)
        .sortWithinPartitions(*order)
        .withColumn(SLICE, F.spark_partition_id())
        .withColumn(POS, F.monotonically_increasing_id() - F.shiftleft(F.spark_partition_id().cast("bigint"), 33))
        .drop(ROW_ID)
    )
    return write_scratch(sliced, label)
