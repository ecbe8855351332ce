"""Publishing one day of a dataset: write beside, check, then replace.

The published day stays readable until its replacement is complete and has passed its
checks, wherever a job is killed:

* **rename** (file systems with an atomic folder rename): rows are written to a folder
  beside, ``_staging/<day>/<run>``. When rows, lengths and quality rules are checked, a
  record ``_published.json`` is put there; then the old day moves to ``_previous``, the new
  one to its place, and the old one is deleted. Where a job was killed between the two
  moves, readers take the recorded new folder, and the next publish of the day finishes it.
* **manifest** (object stores, where a rename is a copy): the job's committer adds new files
  to the day's folder, and putting ``_published.json``, one atomic write that names them, is
  the publication. Readers take the files that it names; what it does not name is deleted
  after it, or by the next publish.

Quality rules are counted by the write itself (an ``Observation``): no second scan. A
breached rule leaves the day as it was; the refused rows stay in ``_rejected/<day>`` for
inspection (rename) or are deleted (manifest). A day has one writer at a time.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Mapping
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

RECORD = "_published.json"
#: Schemes whose folder rename is one atomic step.
RENAMING = ("file", "hdfs", "viewfs")


@dataclass(frozen=True)
class Gate:
    """Rules that rows must keep to be published. ``allowed``: the share of rows that may
    break a rule (none, unless named). A rule that is NULL for a row counts as unknown, not
    as broken."""

    rules: Mapping[str, Column]
    allowed: Mapping[str, float] = field(default_factory=dict)


@dataclass(frozen=True)
class RuleCount:
    rule: str
    violations: int
    unknown: int
    checked: int


@dataclass(frozen=True)
class Published:
    rows: int
    rules: tuple[RuleCount, ...]
    files: dict[str, int]


class QualityGateError(ValueError):
    """A day was not published because rows break its rules."""

    def __init__(self, label: str, broken: list[RuleCount]):
        self.broken = tuple(broken)
        found = ", ".join(f"{r.rule}: {r.violations} of {r.checked} rows" for r in broken)
        super().__init__(f"{label} not published, rules broken: {found}")


class Store:
    """File operations by Hadoop paths on whatever file system a path names."""

    def __init__(self, spark: SparkSession, path: str):
        self._jvm = spark._jvm
        self.system = self._path(path).getFileSystem(spark._jsc.hadoopConfiguration())

    def _path(self, path: str):
        return self._jvm.org.apache.hadoop.fs.Path(path)

    @property
    def scheme(self) -> str:
        return self.system.getUri().getScheme()

    def exists(self, path: str) -> bool:
        return self.system.exists(self._path(path))

    def delete(self, path: str) -> None:
        self.system.delete(self._path(path), True)

    def move(self, source: str, target: str) -> None:
        self.system.mkdirs(self._path(target).getParent())
        if not self.system.rename(self._path(source), self._path(target)):
            raise OSError(f"could not move {source} to {target}")

    def listing(self, path: str) -> dict[str, tuple[int, int]]:
        """Length and time of every file below ``path`` by its name relative to it; hidden
        files and folders but the publication record are left out."""
        found, place = {}, self._path(path)
        if not self.system.exists(place):
            return found
        root = self.system.getFileStatus(place).getPath().toString()
        files = self.system.listFiles(place, True)
        while files.hasNext():
            file = files.next()
            name = file.getPath().toString()[len(root) :].lstrip("/") or file.getPath().getName()
            if not any(part.startswith(("_", ".")) for part in name.removesuffix(RECORD).split("/")):
                found[name] = file.getLen(), file.getModificationTime()
        return found

    def folders(self, path: str) -> list[str]:
        place = self._path(path)
        if not self.system.exists(place):
            return []
        return sorted(s.getPath().getName() for s in self.system.listStatus(place) if s.isDirectory())

    def read(self, path: str) -> str | None:
        if not self.exists(path):
            return None
        stream = self.system.open(self._path(path))
        try:
            return self._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
        finally:
            stream.close()

    def put(self, path: str, text: str) -> None:
        stream = self.system.create(self._path(path), True)
        try:
            stream.write(bytearray(text.encode()))
        finally:
            stream.close()


def _lengths(store: Store, path: str) -> dict[str, int]:
    return {n: size for n, (size, _) in store.listing(path).items() if not n.endswith(RECORD)}


def _around(day: str) -> tuple[str, str]:
    root, _, name = day.rpartition("/")
    return root, name


def _staged(store: Store, day: str) -> str | None:
    """The folder of an interrupted publish that is complete and checked, if there is one."""
    root, name = _around(day)
    for run in store.folders(f"{root}/_staging/{name}"):
        if store.exists(f"{root}/_staging/{name}/{run}/{RECORD}"):
            return f"{root}/_staging/{name}/{run}"
    return None


def published_location(spark: SparkSession, day: str) -> tuple[str, list[str] | None]:
    """Where the published rows of a day lie: the folder, and its files if only some of them
    are published. The day itself, or what a publish that was killed between its two moves
    left; nothing is changed."""
    store = Store(spark, day)
    if store.exists(day):
        record = store.read(f"{day}/{RECORD}")
        known = json.loads(record) if record else {}
        return day, [f"{day}/{name}" for name in known["files"]] if known.get("protocol") == "manifest" else None
    root, name = _around(day)
    previous = f"{root}/_previous/{name}"
    return _staged(store, day) or (previous if store.exists(previous) else day), None


def settle(spark: SparkSession, day: str) -> None:
    """Finish or undo an interrupted publish of a day, and remove what it left."""
    store = Store(spark, day)
    root, name = _around(day)
    previous, staging = f"{root}/_previous/{name}", f"{root}/_staging/{name}"
    if not store.exists(day):
        left = _staged(store, day) or (previous if store.exists(previous) else None)
        if left:
            store.move(left, day)
    for path in (previous, staging):
        if store.exists(path):
            store.delete(path)
    record = store.read(f"{day}/{RECORD}")
    if record and (known := json.loads(record)).get("protocol") == "manifest":
        for file in _lengths(store, day).keys() - known["files"].keys():
            store.delete(f"{day}/{file}")


def publish(df: DataFrame, day: str, *, gate: Gate | None = None, protocol: str | None = None, label: str = "") -> Published:
    """Replace the folder ``day`` by the rows of ``df``, as Parquet.

    ``protocol``: "rename" or "manifest"; by default by the scheme of the path. Breached
    rules raise ``QualityGateError``, a file or row that the write reported and the folder
    does not have raises ``OSError``; the day then stays as it was.
    """
    spark = df.sparkSession
    store = Store(spark, day)
    protocol = protocol or ("rename" if store.scheme in RENAMING else "manifest")
    label = label or day
    settle(spark, day)
    root, name = _around(day)
    rules = list((gate.rules if gate else {}).items())
    counts = [F.count(F.lit(1)).alias("rows")]
    for i, (_, holds) in enumerate(rules):
        counts += [F.count_if(~holds).alias(f"v{i}"), F.count_if(holds.isNull()).alias(f"u{i}")]
    seen = Observation(uuid.uuid4().hex)
    observed = df.observe(seen, *counts)
    before = _lengths(store, day) if protocol == "manifest" else {}
    if protocol == "manifest":
        target = day
        observed.write.mode("append").parquet(target)
    else:
        target = f"{root}/_staging/{name}/{uuid.uuid4().hex}"
        observed.write.parquet(target)
    found = seen.get
    rows = int(found["rows"])
    files = {n: size for n, size in _lengths(store, target).items() if n not in before}
    checked = tuple(RuleCount(rule, int(found[f"v{i}"]), int(found[f"u{i}"]), rows) for i, (rule, _) in enumerate(rules))
    broken = [r for r in checked if r.violations > gate.allowed.get(r.rule, 0.0) * rows]
    # row counts come from the files' footers
    written = spark.read.parquet(*[f"{target}/{n}" for n in files]).count() if files else 0
    if broken or written != rows:
        if protocol == "rename" and broken:
            store.delete(f"{root}/_rejected/{name}")
            store.move(target, f"{root}/_rejected/{name}")
        for n in files if protocol == "manifest" else ():
            store.delete(f"{day}/{n}")
        if broken:
            raise QualityGateError(label, broken)
        raise OSError(f"{label}: {rows} rows written, {written} found in {target}")
    record = json.dumps({"protocol": protocol, "rows": rows, "files": files})
    store.put(f"{target}/{RECORD}", record)
    if protocol == "manifest":
        for n in before:
            store.delete(f"{day}/{n}")
    else:
        if store.exists(day):
            store.move(day, f"{root}/_previous/{name}")
        store.move(target, day)
        settle(spark, day)
        if _lengths(store, day) != files:
            raise OSError(f"{label}: files of {day} changed while they were published")
    return Published(rows, checked, files)
