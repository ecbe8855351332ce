"""Ledger of the finished steps of a day, so that a run goes on after its last good step.

A step's entry says what it read and what it published: a fingerprint of the names, lengths
and times of the files of each input and of its output. A step is done if its inputs and
options are those of the entry and its output is still the one that it published.
"""

from __future__ import annotations

import hashlib
import json
from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import SparkSession

from layercake.sources.publish import Store


def fingerprint(spark: SparkSession, path: str) -> str:
    """A digest of the files below ``path`` (or of the file)."""
    files = sorted(Store(spark, path).listing(path).items())
    return hashlib.sha256(json.dumps(files).encode()).hexdigest()


class Ledger:
    """The entries of one day below ``<base>/_ledger``."""

    def __init__(self, spark: SparkSession, base: str, day: str):
        self.spark = spark
        self.root = f"{base.rstrip('/')}/_ledger/{day}"
        self.store = Store(spark, self.root)

    def entry(self, step: str) -> dict | None:
        text = self.store.read(f"{self.root}/{step}.json")
        try:
            return json.loads(text) if text else None
        except ValueError:  # killed while it was written
            return None

    def run(self, step: str, inputs: Sequence[str], output: str, options: Mapping[str, str], work: Callable[[], int], resume: bool) -> tuple[int, bool]:
        """Do a step, or skip it if ``resume`` and it is done: the rows of its output, and
        whether it was skipped."""
        read = {path: fingerprint(self.spark, path) for path in inputs}
        known = self.entry(step) if resume else None
        if known and known["inputs"] == read and known["options"] == dict(options) and known["output"] == fingerprint(self.spark, output):
            return known["rows"], True
        rows = work()
        entry = {"inputs": read, "options": dict(options), "rows": rows, "output": fingerprint(self.spark, output)}
        self.store.put(f"{self.root}/{step}.json", json.dumps(entry))
        return rows, False
