"""Pipeline runners: bronze ingest, silver transforms, gold star schema, and a CLI.

    python -m layercake.plans.runner silver --base s3a://lake --date 2026-09-18
    python -m layercake.plans.runner all --base /data/lake --source-dir /data/source

One business date is resolved once (argument, ``$PARTITION_DATE`` or today in
the business time zone) and passed to every layer. Every step reads its inputs
from the previous layer's partition of that date and replaces its own
partition of that date only, so a re-run is idempotent and other days are
untouched. A replacement is published once it is complete and has passed the quality
gate of its dataset. Failures name the dataset and propagate (fail fast); a run with
``resume`` skips the steps that the day's ledger knows as done.
"""

from __future__ import annotations

import argparse
import logging
import time
from collections.abc import Callable, Mapping, Sequence
from concurrent.futures import ThreadPoolExecutor, wait
from dataclasses import dataclass, field

from pyspark.errors import ArithmeticException, NumberFormatException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from layercake.plans import gold, quality, silver
from layercake.plans.ledger import Ledger
from layercake.session import scratch_scope
from layercake.sources import (
    DatasetSpec,
    Gate,
    TypeDriftError,
    all_datasets,
    check_types,
    layer_path,
    object_store_conf_from_env,
    read_csv_source,
    read_layer,
    resolve_base,
    resolve_partition_date,
    write_layer,
)
from layercake.sources.layers import partition_path

log = logging.getLogger("layercake.pipeline")


@dataclass(frozen=True)
class StepResult:
    layer: str
    dataset: str
    rows: int
    seconds: float
    skipped: bool = False


@dataclass(frozen=True)
class Step:
    """One dataset's work: what it reads, what it publishes, and what else decides."""

    layer: str
    dataset: str
    inputs: Sequence[str]
    output: str
    work: Callable[[], int]
    options: Mapping[str, str] = field(default_factory=dict)


#: Rules that a dataset's rows must keep to be published.
GATES: dict[str, Callable[[float], Gate]] = {"silver.crm.sales_details": quality.sales_gate, "gold.fact_sales": quality.fact_gate}


def _gate(name: str, tolerance: float | None) -> Gate | None:
    return None if tolerance is None or name not in GATES else GATES[name](tolerance)


@dataclass(frozen=True)
class SilverStep:
    """One silver dataset: ``transform(bronze_frame, as_of) -> silver_frame``."""

    source: str
    name: str
    transform: Callable[[DataFrame, str], DataFrame]

    @property
    def qualified(self) -> str:
        return f"{self.source}.{self.name}"


SILVER_STEPS: tuple[SilverStep, ...] = (
    SilverStep("crm", "cust_info", lambda df, as_of: silver.cust_info(df)),
    SilverStep("crm", "prd_info", lambda df, as_of: silver.prd_info(df)),
    SilverStep("crm", "sales_details", lambda df, as_of: silver.sales_details(df)),
    SilverStep("erp", "cust_az12", silver.cust_az12),
    SilverStep("erp", "loc_a101", lambda df, as_of: silver.loc_a101(df)),
    SilverStep("erp", "px_cat_g1v2", lambda df, as_of: silver.px_cat_g1v2(df)),
)


def silver_step(qualified: str) -> SilverStep:
    """Registry lookup by 'source.dataset'; unknown names raise ``ValueError``."""
    for step in SILVER_STEPS:
        if step.qualified == qualified:
            return step
    known = ", ".join(s.qualified for s in SILVER_STEPS)
    raise ValueError(f"unknown silver dataset {qualified!r}; known: {known}")


def _do(layer: str, dataset: str, work: Callable[[], int | tuple[int, bool]]) -> StepResult:
    name = f"{layer} {dataset}"
    began = time.perf_counter()
    try:
        done = work()
    except Exception:
        log.exception("%s failed, its published day is unchanged", name)
        raise
    rows, skipped = done if isinstance(done, tuple) else (done, False)
    seconds = time.perf_counter() - began
    log.info("%s: %s, %d rows (%.1f s)", name, "done before" if skipped else "published", rows, seconds)
    return StepResult(layer, dataset, rows, seconds, skipped)


def _run_steps(layer: str, steps: Sequence[tuple[str, Callable[[], int | tuple[int, bool]]]], parallelism: int) -> list[StepResult]:
    """Run independent steps (name, work that returns the rows, or rows and whether it was
    done before), ``parallelism`` at a time, as concurrent jobs of the same session. Results
    keep the step order. After a failure no other step starts; those under way end, then the
    failure propagates."""
    failures: list[BaseException] = []

    def run(dataset: str, work: Callable[[], int | tuple[int, bool]]) -> StepResult | None:
        if failures:
            return None
        try:
            return _do(layer, dataset, work)
        except BaseException as failure:
            failures.append(failure)  # before this thread takes its next step
            raise

    with ThreadPoolExecutor(max_workers=max(1, parallelism), thread_name_prefix=f"layercake-{layer}") as pool:
        futures = [pool.submit(run, *step) for step in steps]
        wait(futures)
    if failures:
        raise failures[0]
    return [f.result() for f in futures]


def _run_ledgered(spark: SparkSession, base: str, day: str, steps: Sequence[Step], parallelism: int, resume: bool) -> list[StepResult]:
    """Steps of one layer, each entered in the day's ledger when it is done."""
    ledger = Ledger(spark, base, day)

    def entered(step: Step) -> Callable[[], tuple[int, bool]]:
        return lambda: ledger.run(f"{step.layer}.{step.dataset}", step.inputs, step.output, step.options, step.work, resume)

    return _run_steps(steps[0].layer, [(step.dataset, entered(step)) for step in steps], parallelism)


def _day(base: str, layer: str, name: str, day: str, source: str | None = None) -> str:
    return partition_path(layer_path(base, layer, name, source), day)


def run_bronze(
    spark: SparkSession,
    base: str,
    source_dir: str,
    date: str | None = None,
    parallelism: int = 1,
    multi_line: bool | None = None,
    resume: bool = False,
) -> list[StepResult]:
    """CSV files of every catalogued dataset -> bronze partitions of ``date``;
    ``multi_line`` as in ``read_csv_source``."""
    day = resolve_partition_date(date)

    def ingest(spec: DatasetSpec, path: str) -> int:
        with scratch_scope(spark):
            try:
                return write_layer(read_csv_source(spark, path, spec, multi_line=multi_line), base, "bronze", spec.name, day, spec.source)
            except (ArithmeticException, NumberFormatException) as failure:
                # a second pass, only now, names the columns that have other types than declared
                try:
                    check_types(spark, path, spec, multi_line=multi_line)
                except TypeDriftError as drift:
                    raise drift from failure
                raise

    steps = []
    for spec in all_datasets():
        path = f"{source_dir.rstrip('/')}/{spec.source}/{spec.source_file}"
        steps.append(Step("bronze", spec.qualified, [path], _day(base, "bronze", spec.name, day, spec.source), lambda spec=spec, path=path: ingest(spec, path)))
    return _run_ledgered(spark, base, day, steps, parallelism, resume)


def transform_dataset(
    spark: SparkSession, base: str, qualified: str, date: str | None = None, as_of: str | None = None, tolerance: float | None = quality.TOLERANCE
) -> int:
    """Run one silver dataset for one day; returns the rows written. ``tolerance``: the share
    of rows that may break a rule of the dataset's gate; None: no gate."""
    step = silver_step(qualified)
    day = resolve_partition_date(date)
    with scratch_scope(spark):
        bronze = read_layer(spark, base, "bronze", step.name, day, step.source)
        gate = _gate(f"silver.{qualified}", tolerance)
        return write_layer(step.transform(bronze, as_of or day), base, "silver", step.name, day, step.source, gate=gate)


def run_silver(
    spark: SparkSession,
    base: str,
    date: str | None = None,
    as_of: str | None = None,
    datasets: Sequence[str] | None = None,
    parallelism: int = 1,
    tolerance: float | None = quality.TOLERANCE,
    resume: bool = False,
) -> list[StepResult]:
    """Every silver dataset (or the named ones) for one day. The datasets are
    independent, so ``parallelism`` > 1 submits them as concurrent jobs."""
    day = resolve_partition_date(date)
    options = {"as_of": as_of or day, "tolerance": str(tolerance)}
    steps = []
    for name in datasets or [s.qualified for s in SILVER_STEPS]:
        known = silver_step(name)
        places = [_day(base, layer, known.name, day, known.source) for layer in ("bronze", "silver")]
        steps.append(Step("silver", name, places[:1], places[1], lambda name=name: transform_dataset(spark, base, name, day, as_of, tolerance), options))
    return _run_ledgered(spark, base, day, steps, parallelism, resume)


def run_gold(
    spark: SparkSession, base: str, date: str | None = None, parallelism: int = 1, tolerance: float | None = quality.TOLERANCE, resume: bool = False
) -> list[StepResult]:
    """Dimensions first (concurrently when ``parallelism`` > 1), then the fact,
    which reads the *written* dimensions so the surrogate keys it resolves are
    exactly the published ones."""
    day = resolve_partition_date(date)

    def s(source: str, name: str) -> DataFrame:
        return read_layer(spark, base, "silver", name, day, source)

    def customers() -> int:
        with scratch_scope(spark):
            dim = gold.dim_customers(s("crm", "cust_info"), s("erp", "cust_az12"), s("erp", "loc_a101"))
            return write_layer(dim, base, "gold", "dim_customers", day)

    def products() -> int:
        with scratch_scope(spark):
            dim = gold.dim_products(s("crm", "prd_info"), s("erp", "px_cat_g1v2"))
            return write_layer(dim, base, "gold", "dim_products", day)

    def sales() -> int:
        fact = gold.fact_sales(
            s("crm", "sales_details"),
            read_layer(spark, base, "gold", "dim_products", day),
            read_layer(spark, base, "gold", "dim_customers", day),
        )
        return write_layer(fact, base, "gold", "fact_sales", day, gate=_gate("gold.fact_sales", tolerance))

    def step(name: str, work: Callable[[], int], silver_inputs: Sequence[str], gold_inputs: Sequence[str] = ()) -> Step:
        inputs = [_day(base, "silver", n.partition(".")[2], day, n.partition(".")[0]) for n in silver_inputs]
        inputs += [_day(base, "gold", n, day) for n in gold_inputs]
        return Step("gold", name, inputs, _day(base, "gold", name, day), work, {"tolerance": str(tolerance)})

    dims = [
        step("dim_customers", customers, ["crm.cust_info", "erp.cust_az12", "erp.loc_a101"]),
        step("dim_products", products, ["crm.prd_info", "erp.px_cat_g1v2"]),
    ]
    fact = step("fact_sales", sales, ["crm.sales_details"], ["dim_products", "dim_customers"])
    results = _run_ledgered(spark, base, day, dims, parallelism, resume)
    return results + _run_ledgered(spark, base, day, [fact], 1, resume)


def run_all(
    spark: SparkSession,
    base: str,
    source_dir: str,
    date: str | None = None,
    parallelism: int = 1,
    multi_line: bool | None = None,
    tolerance: float | None = quality.TOLERANCE,
    resume: bool = False,
) -> list[StepResult]:
    """bronze -> silver -> gold for one business date."""
    day = resolve_partition_date(date)
    return [
        *run_bronze(spark, base, source_dir, day, parallelism, multi_line, resume),
        *run_silver(spark, base, day, parallelism=parallelism, tolerance=tolerance, resume=resume),
        *run_gold(spark, base, day, parallelism, tolerance, resume),
    ]


def metrics_frame(spark: SparkSession, results: Sequence[StepResult]) -> DataFrame:
    """Run metrics as a DataFrame (layer, dataset, rows, seconds)."""
    return spark.createDataFrame(
        [(r.layer, r.dataset, r.rows, r.seconds) for r in results],
        "layer string, dataset string, rows bigint, seconds double",
    )


def write_metrics(spark: SparkSession, results: Sequence[StepResult], path: str, date: str) -> None:
    """Append the run's metrics, with its business date, to a Parquet table."""
    metrics_frame(spark, results).withColumn("date", F.lit(date)).coalesce(1).write.mode("append").parquet(path)


def main(argv: Sequence[str] | None = None) -> int:
    parser = argparse.ArgumentParser(description="Run the layered pipeline for one business date.")
    parser.add_argument("layer", choices=["bronze", "silver", "gold", "all"])
    parser.add_argument("--base", help="lake root URI (file:, s3a://...); default s3a://<bucket> from the environment, else ./data")
    parser.add_argument("--date", "--partition-date", dest="date", help="YYYY-MM-DD")
    parser.add_argument("--source-dir", help="folder with <source>/<file>.csv (bronze, all)")
    parser.add_argument("--dataset", action="append", help="silver dataset 'source.name' (repeatable)")
    parser.add_argument("--as-of", help="business date for future-date checks (default: --date)")
    parser.add_argument("--parallel", type=int, default=1, help="independent datasets run concurrently")
    parser.add_argument("--multi-line", choices=["auto", "yes", "no"], default="auto", help="no: values of the CSV files hold no newlines")
    parser.add_argument("--tolerance", type=float, default=quality.TOLERANCE, help="share of rows that may break a quality rule and be published; negative: no rules")
    parser.add_argument("--resume", action="store_true", help="skip steps that the day's ledger knows as done")
    parser.add_argument("--metrics", help="Parquet table to append rows and seconds of each step to")
    args = parser.parse_args(argv)
    logging.basicConfig(level=logging.INFO, format="%(asctime)s | %(levelname)s | %(message)s")
    logging.getLogger("py4j").setLevel(logging.WARNING)

    from layercake.session import CLUSTER_CONF, build_session

    spark = build_session(
        app_name=f"layercake-{args.layer}", extra={**CLUSTER_CONF, **object_store_conf_from_env()}
    )
    args.base = resolve_base(args.base)
    args.date = resolve_partition_date(args.date)
    multi_line = {"auto": None, "yes": True, "no": False}[args.multi_line]
    if not spark.sparkContext.getCheckpointDir():
        # beside the lake: a folder that all executors share
        spark.sparkContext.setCheckpointDir(f"{args.base.rstrip('/')}/_scratch")
    if args.layer in ("bronze", "all") and not args.source_dir:
        parser.error("--source-dir is required for bronze")
    try:
        how = {"tolerance": None if args.tolerance < 0 else args.tolerance, "resume": args.resume}
        if args.layer == "bronze":
            results = run_bronze(spark, args.base, args.source_dir, args.date, args.parallel, multi_line, args.resume)
        elif args.layer == "silver":
            results = run_silver(spark, args.base, args.date, args.as_of, args.dataset, args.parallel, **how)
        elif args.layer == "gold":
            results = run_gold(spark, args.base, args.date, args.parallel, **how)
        else:
            results = run_all(spark, args.base, args.source_dir, args.date, args.parallel, multi_line, **how)
        if args.metrics:
            write_metrics(spark, results, args.metrics, args.date)
    finally:
        spark.stop()
    log.info("total rows written: %d", sum(r.rows for r in results))
    return 0


if __name__ == "__main__":
    raise SystemExit(main())
