"""Bronze: landing files -> typed, partitioned tables that keep the source columns."""

from __future__ import annotations

import uuid
from collections.abc import Sequence
from dataclasses import dataclass, field
from datetime import datetime, timezone

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sedimenta.contracts import ContractError, TableContract, quoted
from sedimenta.functions.period import PERIOD_IN_PATH, MonthSet, Period
from sedimenta.operators.conform import Conformed, Extras, conform_all, unfit_columns
from sedimenta.operators.layers import (
    MB,
    WriteMode,
    check_mode,
    compacted,
    distinct_locations,
    write_layer,
)
from sedimenta.operators.validate import Expectations, require_passed, row_counts, verdicts
from sedimenta.sources import rejects
from sedimenta.sources.catalog import (
    BY_LOAD,
    add_months,
    check_table,
    ensure_database,
    ensure_table,
    is_by_load,
    recover,
)
from sedimenta.sources.landing import EmptyLanding, LandingScan, in_period, landing_files, scan
from sedimenta.sources.manifest import STATE, Manifest, Unit, changes, to_read


@dataclass(frozen=True)
class Dataset:
    """One landing file set and the Bronze table it feeds.

    ``compact`` puts a compacting shuffle before the write, for landings of many small files.
    ``split`` is the input per task in bytes where the session sets none. ``grow`` adds columns
    that the contract has gained to an existing table. Rows of files that name no period go to
    ``rejects`` as they came, beside ``location`` unless given; so do, with ``keep_unfit``, rows of
    which a value does not fit, in a second pass over their files.

    ``manifest`` names a folder that remembers the files of every load, so that a later one reads
    changed files only. With ``expected`` a load is written to a folder of its own, and readers of
    the table see it after it has passed; such folders lie beside ``location``.
    """

    contract: TableContract
    landing: str
    location: str
    extras: Extras = "keep"
    pattern: str = PERIOD_IN_PATH
    compact: bool = False
    split: int = 128 * MB
    grow: bool = False
    rejects: str | None = None
    keep_unfit: bool = False
    manifest: str | None = None
    expected: Expectations | None = None

    @property
    def reject_folder(self) -> str:
        return self.rejects or f"{self.location.rstrip('/')}_rejects"

    @property
    def loads_folder(self) -> str:
        return f"{self.location.rstrip('/')}_loads"

    @property
    def folders(self) -> tuple[str, ...]:
        """Everything that a load writes to."""
        own = (self.location, self.reject_folder, self.loads_folder)
        return (*own, self.manifest) if self.manifest else own


@dataclass(frozen=True)
class LoadReport:
    """Outcome of one dataset.

    ``status``: ``ok``; ``rejected`` when rows went to the reject folder because their file names
    no period; ``lossy`` when values did not fit; ``unchanged`` when there was nothing new to load;
    ``empty`` when there was no file; ``failed``. ``rejected`` and ``lossy`` can hold both.
    ``rows_read`` is counted at the scan, ``rows_written`` and ``rows_without_period`` at the write.
    ``values_lost`` counts, per column, the values that did not fit the declared type. ``load`` names
    the load in the reject folder and the manifest, ``months`` are those that it wrote.
    """

    dataset: str
    status: str
    rows_read: int = 0
    rows_written: int = 0
    rows_without_period: int = 0
    values_lost: dict[str, int] = field(default_factory=dict)
    message: str = ""
    load: str = ""
    months: frozenset[tuple[int, int]] = frozenset()

    @property
    def rejected(self) -> bool:
        return self.rows_without_period > 0

    @property
    def lossy(self) -> bool:
        return bool(self.values_lost)


REPORT_SCHEMA = T.StructType(
    [
        T.StructField("dataset", T.StringType(), False),
        T.StructField("status", T.StringType(), False),
        T.StructField("rejected", T.BooleanType(), False),
        T.StructField("lossy", T.BooleanType(), False),
        T.StructField("rows_read", T.LongType(), False),
        T.StructField("rows_written", T.LongType(), False),
        T.StructField("rows_without_period", T.LongType(), False),
        T.StructField("values_lost", T.MapType(T.StringType(), T.LongType()), False),
        T.StructField("message", T.StringType(), False),
        T.StructField("load", T.StringType(), False),
    ]
)


def report_frame(spark: SparkSession, reports: Sequence[LoadReport]) -> DataFrame:
    """The reports, one row per dataset."""
    rows = [tuple(getattr(r, name) for name in REPORT_SCHEMA.names) for r in reports]
    return spark.createDataFrame(rows, REPORT_SCHEMA)


def _new_load() -> str:
    """Name of a load: later ones sort behind earlier ones."""
    return f"{datetime.now(timezone.utc):%Y%m%dT%H%M%S%f}-{uuid.uuid4().hex[:8]}"


def ingest(
    spark: SparkSession,
    dataset: Dataset,
    mode: WriteMode = "replace_partitions",
    period: Period | None = None,
    changed_only: bool = False,
) -> LoadReport:
    """Load one dataset in one write and register its partitions.

    Each landing file holds one month, so scan tasks write their rows straight into the
    right partitions: no shuffle, and a hot month is spread like any other. The counts of
    the report are observed in the writing stage, not read again.

    ``changed_only`` reads what the manifest does not have: all files of months in which a file is
    new, changed or gone, as a month is replaced as a whole; in ``append`` changed files alone. A
    month whose files are all gone stays. ``append`` to a table with a file key leaves out files
    that the table has rows of, whatever the manifest says.
    """
    _check(spark, dataset, mode, period, changed_only)
    contract, load = dataset.contract, _new_load()
    manifest = Manifest(dataset.manifest) if dataset.manifest else None
    staged, message = _staged(spark, dataset, mode, period, changed_only, manifest, load)
    if staged is None:
        return LoadReport(contract.name, "unchanged", message=message, load=load)
    undated = rejects.keep(
        staged.without_period, F.lit("no period"), dataset.reject_folder, load, "undated"
    )
    if undated:
        files = staged.summary.files_without_period
        message = "; ".join(
            filter(None, (f"{files} files name no period: {dataset.reject_folder}/load={load}", message))
        )

    read, written, lost, months = undated, 0, {}, frozenset()
    if staged.groups:
        conformed = conform_all(staged.groups, contract, dataset.extras)
        target = f"{dataset.loads_folder}/load={load}" if dataset.expected else dataset.location
        counts = _write(conformed, dataset, target, "replace_all" if dataset.expected else mode)
        read += counts["read"]
        written, lost, months = counts["written"], counts["lost"], staged.summary.months
        if lost and dataset.keep_unfit:
            _keep_unfit(staged, dataset, load)
        if dataset.expected is not None:
            months = _publish(spark, dataset, target, mode)
        else:
            register(spark, contract, dataset.location, months, replaced_all=mode == "replace_all")
    if manifest:
        manifest.done(spark, load)
    return LoadReport(
        dataset=contract.name,
        status="rejected" if undated else "lossy" if lost else "ok",
        rows_read=read,
        rows_written=written,
        rows_without_period=undated,
        values_lost=lost,
        message=message,
        load=load,
        months=months,
    )


def _check(
    spark: SparkSession, dataset: Dataset, mode: WriteMode, period: Period | None, changed_only: bool
) -> None:
    """Refuse what cannot go well before anything is read or written."""
    check_mode(mode)
    if mode == "replace_all" and (period is not None or changed_only):
        raise ValueError("some months with replace_all would drop all other months")
    if changed_only and dataset.manifest is None:
        raise ValueError("only changed files: the dataset names no manifest")
    if dataset.expected is not None and mode == "append":
        raise ValueError("a month that is published after a check is replaced, not appended to")
    contract = dataset.contract
    distinct_locations(dataset.landing, *dataset.folders)
    check_table(spark, contract, dataset.location, dataset.grow)
    if spark.catalog.tableExists(quoted(contract.name)):
        if is_by_load(spark, contract.name) != (dataset.expected is not None):
            raise ContractError(f"{contract.name}: loads with and without a check do not go together")


def _staged(
    spark: SparkSession,
    dataset: Dataset,
    mode: WriteMode,
    period: Period | None,
    changed_only: bool,
    manifest: Manifest | None,
    load: str,
) -> tuple[LandingScan | None, str]:
    """The scan of what is to be loaded, None if that is nothing, and a remark."""
    contract = dataset.contract
    once = mode == "append" and contract.file_key is not None and spark.catalog.tableExists(quoted(contract.name))
    if manifest is None and not once:
        return scan(spark, dataset.landing, contract, dataset.pattern, period), ""
    listed = landing_files(spark, dataset.landing, dataset.pattern)
    wanted, message = None, ""
    known = keep = None
    if manifest is not None:
        keep = manifest.files_of(load)
        known = manifest.known(spark)
        changed = changes(listed.where(in_period(period)), known.where(in_period(period)))
        unit: Unit = "file" if mode == "append" else "month"
        if changed_only:
            if changed.isEmpty():
                return None, "no file is new, changed or gone"
            wanted = to_read(listed, changed, unit)
        message = _gone(listed, changed, manifest.files_of(load, "gone"))
    if once:
        asked = listed if wanted is None else listed.join(wanted, "path", "left_semi")
        wanted = _not_appended(spark, contract, asked)
        if manifest is not None:
            appended = asked.join(wanted, "path", "left_anti")
            appended.select(*_state(appended)).write.parquet(manifest.files_of(load, "appended"))
    if wanted is not None and wanted.isEmpty():
        if manifest is not None:
            manifest.done(spark, load)
        return None, message or "all files have been appended before"
    found = scan(
        spark, dataset.landing, contract, dataset.pattern, period,
        listed=listed, wanted=wanted, known=known, keep=keep,
    )
    return found, message


def _gone(listed: DataFrame, changed: DataFrame, keep: str) -> str:
    """Note files that are gone, and say which months have none left."""
    gone = changed.where("gone")
    if gone.isEmpty():
        return ""
    gone.select(*_state(gone)).write.parquet(keep)
    left = gone.select("year", "month").distinct().join(listed, ["year", "month"], "left_anti")
    months = sorted(f"{r['year']}-{r['month']:02d}" for r in left.where("month IS NOT NULL").collect())
    return f"no file left for {', '.join(months)}" if months else ""


def _state(files: DataFrame) -> list[Column]:
    """Columns of the manifest; NULL what is not known of the files."""
    return [
        F.col(f.name) if f.name in files.columns else F.lit(None).cast(f.dataType).alias(f.name)
        for f in STATE.fields
    ]


def _not_appended(spark: SparkSession, contract: TableContract, listed: DataFrame) -> DataFrame:
    """Paths of the files that the table has no row of, month by month."""
    year, month = contract.partition_by
    there = spark.table(quoted(contract.name)).select(
        F.col(year).alias("year"), F.col(month).alias("month"), F.col(contract.file_key).alias("key")
    )
    return listed.join(there.distinct(), ["year", "month", "key"], "left_anti").select("path")


def _write(conformed: Conformed, dataset: Dataset, target: str, mode: WriteMode) -> dict:
    """Write the rows; how many were read and written, and which values were lost."""
    contract = dataset.contract
    scanned = Observation()
    rows = conformed.rows.observe(scanned, F.count("*").alias("rows"))
    if dataset.compact:
        rows = compacted(rows, contract.partition_by)
    # Observed behind the shuffle, if there is one: a rerun of its tasks counts once.
    seen = Observation()
    rows = rows.observe(seen, F.count("*").alias("__rows"), *conformed.lost_counts())
    rows = rows.drop(*conformed.lost_flags)
    if contract.loaded_at:
        rows = rows.withColumn(contract.loaded_at, F.current_timestamp())
    write_layer(rows, target, contract.partition_by, mode, dataset.split)
    counts = dict(seen.get)
    return {
        "read": scanned.get["rows"],
        "written": counts.pop("__rows"),
        "lost": {name: n for name, n in counts.items() if n},
    }


def _keep_unfit(staged: LandingScan, dataset: Dataset, load: str) -> None:
    """Rows of which a value does not fit, as they came."""
    for number, df in enumerate(staged.groups):
        unfit = unfit_columns(df, dataset.contract.columns)
        if unfit is not None:
            reason = F.concat(F.lit("does not fit: "), F.array_join(unfit, ", "))
            some = df.where(F.size(unfit) > 0)
            rejects.keep([some], reason, dataset.reject_folder, load, f"unfit-{number}")


def _publish(
    spark: SparkSession, dataset: Dataset, target: str, mode: WriteMode
) -> frozenset[tuple[int, int]]:
    """Check a load in its folder, then let the table's partitions point there; returns its months.

    A load that does not pass stays in its folder; readers keep what they have. The switch is one
    catalog call for each month that the table has already, so a run that is cut off there can leave
    some months at the new load; a rerun of the load completes it.
    """
    contract = dataset.contract
    new = spark.read.schema(contract.table_schema).parquet(target)
    # Reads no column of the files.
    found = new.select(*contract.partition_by).distinct().collect()
    months = frozenset((year, month) for year, month in found)
    if any(None in month for month in months):
        raise ContractError(f"{contract.name}: rows without a period cannot be published")
    there = spark.catalog.tableExists(quoted(contract.name))
    last = None
    if there:
        old = spark.table(quoted(contract.name))
        if mode != "replace_all":
            old = old.where(MonthSet(months).holds(*(F.col(c) for c in contract.partition_by)))
        last = row_counts(old, contract)
    require_passed(verdicts(new, contract, dataset.expected, last), f"{contract.name}, {target}")
    if "." in contract.name:
        ensure_database(spark, contract.name.rsplit(".", 1)[0])
    ensure_table(spark, contract, dataset.location)
    if not there:
        spark.sql(f"ALTER TABLE {quoted(contract.name)} SET TBLPROPERTIES ('{BY_LOAD}' = 'true')")
    add_months(spark, contract, months, target, only=mode == "replace_all")
    return months


def register(
    spark: SparkSession,
    contract: TableContract,
    location: str,
    months: frozenset[tuple[int, int]] | None,
    replaced_all: bool,
) -> None:
    """Database, table and partitions of a layer that has just been written.

    ``months`` are those of the rows written, or more; without them the table's folders are listed.
    """
    if "." in contract.name:
        ensure_database(spark, contract.name.rsplit(".", 1)[0])
    ensure_table(spark, contract, location)
    if months is None:
        recover(spark, contract.name, drop_missing=replaced_all)
    else:
        add_months(spark, contract, months, only=replaced_all)


def run_bronze(
    spark: SparkSession,
    datasets: Sequence[Dataset],
    mode: WriteMode = "replace_partitions",
    period: Period | None = None,
    changed_only: bool = False,
) -> list[LoadReport]:
    """Load the datasets one after the other; a failed one does not stop the next."""
    reports = []
    for dataset in datasets:
        try:
            reports.append(ingest(spark, dataset, mode, period, changed_only))
        except EmptyLanding as error:
            reports.append(LoadReport(dataset.contract.name, "empty", message=str(error)))
        except Exception as error:  # any fault of one dataset is a line of the report
            message = str(error).strip() or type(error).__name__
            reports.append(LoadReport(dataset.contract.name, "failed", message=message))
    return reports
