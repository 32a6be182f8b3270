"""The whole run: Bronze, Silver, Gold in one session."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

from sedimenta.functions.period import MonthSet, Period
from sedimenta.operators.layers import WriteMode, distinct_locations
from sedimenta.operators.materialize import MaterializeMode
from sedimenta.plans.bronze import Dataset, LoadReport, run_bronze
from sedimenta.plans.gold import GoldResult, IncrementalResult, run_gold
from sedimenta.plans.silver import PipelineError, SilverLayer, run_silver
from sedimenta.sources.manifest import Manifest


@dataclass(frozen=True)
class Pipeline:
    """Configuration of a whole run. No two locations may overlap."""

    bronze: tuple[Dataset, ...]
    silver: SilverLayer
    gold: tuple[GoldResult | IncrementalResult, ...]

    def __post_init__(self) -> None:
        distinct_locations(
            *(d.landing for d in self.bronze),
            *(folder for d in self.bronze for folder in d.folders),
            self.silver.location,
            *(folder for g in self.gold for folder in g.folders),
        )


@dataclass(frozen=True)
class RunResult:
    reports: tuple[LoadReport, ...]
    gold: dict[str, DataFrame]


def require_loaded(
    reports: list[LoadReport],
    allow_rejected: bool = False,
    allow_lossy: bool = False,
    allow_empty: bool = False,
) -> None:
    """Raise if a dataset failed or had no file, or rows or values of it are missing, unless allowed.

    No later layer is built on half the data.
    """
    faults = []
    for r in reports:
        lost = ", ".join(f"{n} values of {name}" for name, n in r.values_lost.items())
        if r.status == "failed":
            faults.append(f"{r.dataset}: {r.message}")
        if r.status == "empty" and not allow_empty:
            faults.append(f"{r.dataset}: {r.message}")
        if r.rejected and not allow_rejected:
            faults.append(f"{r.dataset}: {r.rows_without_period} rows rejected, {r.message}")
        if lost and not allow_lossy:
            faults.append(f"{r.dataset}: {lost} do not fit")
    if faults:
        raise PipelineError("; ".join(faults))


def open_loads(
    spark: SparkSession, pipeline: Pipeline
) -> tuple[list[tuple[Manifest, str]], MonthSet]:
    """Loads that Silver and Gold do not have yet, those of runs that were cut off included."""
    loads, months = [], set()
    for dataset in pipeline.bronze:
        if dataset.manifest:
            manifest = Manifest(dataset.manifest)
            for load, of_load in manifest.open_loads(spark).items():
                loads.append((manifest, load))
                months |= of_load
    return loads, MonthSet(frozenset(months))


def pass_on(spark: SparkSession, loads: list[tuple[Manifest, str]]) -> None:
    for manifest, load in loads:
        manifest.passed_on(spark, load)


def run_pipeline(
    spark: SparkSession,
    pipeline: Pipeline,
    bronze_mode: WriteMode = "replace_partitions",
    silver_mode: WriteMode | None = None,
    gold_mode: MaterializeMode = "refresh",
    period: Period | None = None,
    allow_rejected: bool = False,
    allow_lossy: bool = False,
    allow_empty: bool = False,
    changed_only: bool = False,
) -> RunResult:
    """Load, unify, aggregate. ``period`` limits the landing files that are loaded.

    Silver is replaced as a whole, or with a ``period`` in its months, unless told otherwise. With
    ``changed_only`` Bronze loads changed months only (see :func:`ingest`), and Silver and the stored
    states of Gold follow in those months, and in months of earlier loads that did not get so far.
    """
    reports = run_bronze(spark, pipeline.bronze, bronze_mode, period, changed_only)
    require_loaded(reports, allow_rejected, allow_lossy, allow_empty)
    loads, changed = open_loads(spark, pipeline)
    months: Period | None = changed if changed_only else period
    silver_mode = silver_mode or ("replace_partitions" if months else "replace_all")
    if silver_mode == "replace_all":
        months = None
    if not isinstance(months, MonthSet) or months.months:
        run_silver(spark, pipeline.silver, silver_mode, months)
    stored = run_gold(spark, pipeline.gold, pipeline.silver.contract.name, gold_mode, months)
    if changed_only or period is None:
        pass_on(spark, loads)
    return RunResult(tuple(reports), stored)
