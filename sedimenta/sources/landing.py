"""Monthly Parquet drops: discovery, period, and one scan per footer schema.

A *drop* is the path up to and including the part that carries the period: a single file,
or a directory of part files.
"""

from __future__ import annotations

import posixpath
import re
from collections.abc import Iterator, Sequence
from concurrent.futures import ThreadPoolExecutor
from contextlib import contextmanager
from dataclasses import dataclass
from datetime import datetime, timedelta, timezone
from functools import reduce
from math import ceil

from py4j.protocol import Py4JJavaError
from pyspark import StorageLevel
from pyspark.errors import AnalysisException, PySparkException
from pyspark.sql import Column, DataFrame, DataFrameReader, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sedimenta.contracts import ContractError, TableContract, quoted_column
from sedimenta.functions.period import (
    ANCHORS,
    PERIOD_IN_PATH,
    Period,
    PeriodSlice,
    period_by_slice,
    period_of,
    slice_of,
)
from sedimenta.session import session_conf
from sedimenta.sources.footers import FAULT, FINGERPRINT, NO_CLIENT, fingerprinted

# Every *.parquet below the root, at any depth; the suffix is matched case-sensitively.
FILE_SET = {"recursiveFileLookup": "true", "pathGlobFilter": "*.parquet"}

_PROBES_AT_ONCE = 8

#: So many file names are put in order by one task; more by several, in the same way.
_FEW = 10_000


class EmptyLanding(Exception):
    """There is no Parquet file to read."""


@dataclass(frozen=True)
class LandingSummary:
    """What the listing says about a file set; one entry per month, not per file.

    ``anchor`` is the way to name the place of the period that needs the fewest ``slices``.
    """

    files: int
    bytes: int
    files_without_period: int
    months: frozenset[tuple[int, int]]
    anchor: str
    slices: frozenset[PeriodSlice]


@dataclass(frozen=True)
class LandingScan:
    """Lazy scan of a landing file set.

    ``groups``: one DataFrame per footer schema and period position, source columns plus
    year and month.
    ``without_period``: one DataFrame per footer schema of the files that name no period.
    """

    groups: tuple[DataFrame, ...]
    without_period: tuple[DataFrame, ...]
    summary: LandingSummary


#: Scans with the place of the period in their paths, None for files without one.
Frames = list[tuple[DataFrame, PeriodSlice | None]]


def _reader(spark: SparkSession) -> DataFrameReader:
    return spark.read.options(**FILE_SET)


def _literal_path(path: str) -> str:
    """Path with glob characters escaped, to name exactly this file or directory."""
    return re.sub(r"([\\{}\[\]*?])", r"\\\1", path)


@contextmanager
def _empty_if_missing(root: str) -> Iterator[None]:
    """Turn Spark's "no such path" and "no file to take a schema from" into EmptyLanding."""
    try:
        yield
    except AnalysisException as error:
        if error.getCondition() in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA"):
            raise EmptyLanding(f"no Parquet file under {root}") from error
        raise


def file_key() -> Column:
    """Number of a landing file in one state, from its path, size and time: the same in a listing
    and in the rows read. Two of n files share one with probability n²/2⁶⁵."""
    at = F.col("_metadata")
    parts = (at.getField(f"file_{name}") for name in ("path", "size", "modification_time"))
    return F.xxhash64(*parts)


def landing_files(spark: SparkSession, root: str, pattern: str = PERIOD_IN_PATH) -> DataFrame:
    """One row per file: path, uri, drop, bytes, modified, key, year, month.

    No file content is read.
    """
    with _empty_if_missing(root):
        files = _reader(spark).format("binaryFile").load(root)
    uri = F.col("_metadata.file_path")
    year, month = period_of(uri, pattern)
    drop = F.regexp_extract("path", f"^(.*?(?:{pattern})[^/]*)", 1)
    return files.select(
        "path",
        uri.alias("uri"),
        F.when(drop == "", F.col("path")).otherwise(drop).alias("drop"),
        F.col("length").alias("bytes"),
        F.col("modificationTime").alias("modified"),
        file_key().alias("key"),
        year.alias("year"),
        month.alias("month"),
    )


def _listing(spark: SparkSession, files: DataFrame) -> list[Row]:
    """Collected listing. Its tasks touch file names only, so they are packed by count of
    cores: the usual split size would give every large file a task of its own."""
    with session_conf(spark, {"spark.sql.files.maxPartitionBytes": str(1 << 50)}):
        return files.collect()


def _listing_tasks(spark: SparkSession) -> dict[str, str]:
    """Named paths are listed by a few tasks per core; Spark's own choice is one per path."""
    tasks = 4 * spark.sparkContext.defaultParallelism
    return {"spark.sql.sources.parallelPartitionDiscovery.parallelism": str(min(tasks, 10000))}


def _summarise(
    spark: SparkSession, files: DataFrame, root: str, pattern: str
) -> tuple[LandingSummary, str, str, datetime]:
    """What the listing says of the files inside; the first and the last path and the last time of all."""

    def places(anchor: str) -> Column:
        return F.collect_set(slice_of(F.col("uri"), pattern, anchor)).alias("slices")

    def distinct(rows: list[Row]) -> frozenset[PeriodSlice]:
        return frozenset(PeriodSlice(**at.asDict()) for row in rows for at in row["slices"])

    every = _listing(
        spark,
        files.groupBy("inside", "year", "month").agg(
            F.count("*").alias("files"),
            F.sum("bytes").alias("bytes"),
            F.min("path").alias("first"),
            F.max("path").alias("last"),
            F.max("modified").alias("modified"),
            places(ANCHORS[0]),
        ),
    )
    months = [m for m in every if m["inside"]]
    if not months:
        raise EmptyLanding(f"no Parquet file under {root} for the months asked for")
    dated = [m for m in months if m["year"] is not None and m["month"] is not None]
    total = sum(m["files"] for m in months)
    slices = {ANCHORS[0]: distinct(dated)}
    if len(slices[ANCHORS[0]]) > 1:
        inside = files.where("inside AND year IS NOT NULL AND month IS NOT NULL")
        for anchor in ANCHORS[1:]:
            slices[anchor] = distinct(_listing(spark, inside.agg(places(anchor))))
    anchor = min(slices, key=lambda a: len(slices[a]))
    summary = LandingSummary(
        files=total,
        bytes=sum(m["bytes"] for m in months),
        files_without_period=total - sum(m["files"] for m in dated),
        months=frozenset((m["year"], m["month"]) for m in dated),
        anchor=anchor,
        slices=slices[anchor],
    )
    bounds = (min(m["first"] for m in every), max(m["last"] for m in every))
    return summary, *bounds, max(m["modified"] for m in every)


def _merged(
    spark: SparkSession, paths: Sequence[str], settled: dict[str, str] | None = None
) -> DataFrame | None:
    """The paths under one merged footer schema, or None if their types disagree.

    Spark reads and merges the footers in a distributed job; an unreadable file raises.
    """
    try:
        reader = _reader(spark).options(**(settled or {}))
        return reader.option("mergeSchema", "true").parquet(*paths)
    except (PySparkException, Py4JJavaError) as error:
        # A condition of its own only where Spark converts the error; else it stands in the text.
        condition = error.getCondition() if isinstance(error, PySparkException) else None
        if "CANNOT_MERGE_SCHEMAS" in (condition or str(error)):
            return None
        raise


def _files_under(spark: SparkSession, paths: Sequence[str]) -> list[str]:
    files = _reader(spark).format("binaryFile").load([_literal_path(p) for p in paths])
    files = files.select("path")
    return sorted((r["path"] for r in _listing(spark, files)), key=_by_writer)


def _by_writer(path: str) -> tuple[str, str]:
    """Order by the form of a name, then by its numbers: ``part-00000-<job id>`` of one job
    stand together, and drops of one form stand in order of their dates."""
    return re.sub(r"\d+", "#", path), path


def _agreeing(left: T.StructType, right: T.StructType) -> T.StructType | None:
    """Both schemas in one, or None if a shared column differs in type or letter case."""
    fields = {f.name.lower(): f for f in left.fields}
    extra = []
    for field in right.fields:
        have = fields.get(field.name.lower())
        if have is None:
            extra.append(field)
        elif (have.name, have.dataType) != (field.name, field.dataType):
            return None
    return T.StructType([*left.fields, *extra])


def _pieces(paths: list[str]) -> list[list[str]]:
    size = ceil(len(paths) / _PROBES_AT_ONCE)
    return [paths[i : i + size] for i in range(0, len(paths), size)]


def schema_groups(
    spark: SparkSession, paths: Sequence[str], disagree: bool = False
) -> list[tuple[DataFrame, list[str]]]:
    """Paths grouped so that each group reads under one schema: the scan of each group.

    Paths in order are cut into pieces until the footers of a piece merge: each writer
    changes a type at some date, so ordered paths fall into a few runs and the number of
    probes follows the number of changes. Runs that agree are put together again, so the number of
    scans is the number of distinct schemas. ``disagree`` says that the paths are known not
    to merge as a whole.
    """
    ordered = sorted(paths, key=_by_writer)
    pending = _pieces(ordered) if disagree and len(ordered) > 1 else [ordered]
    settled: list[tuple[list[str], DataFrame]] = []
    single_files: set[str] = set()
    with ThreadPoolExecutor(_PROBES_AT_ONCE) as pool:
        while pending:
            probes = pool.map(
                lambda run: _merged(spark, [_literal_path(p) for p in run]), pending
            )
            conflicting: list[list[str]] = []
            mixed_drops: list[str] = []
            for run, merged in zip(pending, probes):
                if merged is not None:
                    settled.append((run, merged))
                elif len(run) > 1:
                    conflicting.append(run)
                elif run[0] in single_files:
                    raise ContractError(f"{run[0]}: footer does not merge with itself")
                else:
                    mixed_drops += run
            if mixed_drops:
                conflicting.append(_files_under(spark, mixed_drops))
                single_files.update(conflicting[-1])
            pending = [piece for parts in conflicting for piece in _pieces(parts)]

    groups: list[tuple[T.StructType, list[tuple[list[str], DataFrame]]]] = []
    for run in sorted(settled, key=lambda s: s[0][0]):
        for i, (have, members) in enumerate(groups):
            both = _agreeing(have, run[1].schema)
            if both is not None:
                groups[i] = (both, [*members, run])
                break
        else:
            groups.append((run[1].schema, [run]))

    scans = []
    for schema, members in groups:
        paths = [path for run, _ in members for path in run]
        if len(members) == 1:  # the probe is the scan, no second listing
            scans.append((members[0][1], paths))
        else:
            named = [_literal_path(p) for p in paths]
            scans.append((_reader(spark).schema(schema).parquet(*named), paths))
    return scans


def scan(
    spark: SparkSession,
    root: str,
    contract: TableContract,
    pattern: str = PERIOD_IN_PATH,
    period: Period | None = None,
    listed: DataFrame | None = None,
    wanted: DataFrame | None = None,
    known: DataFrame | None = None,
    keep: str | None = None,
) -> LandingScan:
    """Scan every drop under ``root`` with its year and month.

    ``period`` and ``wanted`` (a frame of ``path``) limit the files that are read. One scan of the
    root when all of them are read and all footers agree; else one scan per distinct schema and
    place of the period, see :func:`_scan_files`. The scan of the root is created before the listing
    that checks it, so a file arriving in between is listed but not read, never read unchecked.

    With ``keep`` the files that are read are written there with their fingerprints, and those of
    ``known`` files are taken from a load before; ``listed`` is a listing that is there already.
    """
    with session_conf(spark, _listing_tasks(spark)):
        every = period is None and wanted is None
        whole = None
        if every and keep is None:
            with _empty_if_missing(root):
                whole = _merged(spark, [root])
        if listed is None:
            listed = landing_files(spark, root, pattern)
        files = listed.withColumn("inside", in_period(period))
        if wanted is not None:
            marked = wanted.select(F.col("path").alias("__path")).distinct()
            files = files.join(marked, F.col("path") == F.col("__path"), "left")
            files = files.withColumn("inside", F.col("inside") & F.col("__path").isNotNull()).drop("__path")
        # Asked for each file once: a listing task looks every file up.
        files = files.persist(StorageLevel.MEMORY_AND_DISK)
        try:
            frames, summary = _read(spark, files, root, pattern, whole, every, known, keep)
        finally:
            files.unpersist()

    return LandingScan(
        groups=tuple(_with_period(df, contract, at) for df, at in frames if at is not None),
        without_period=tuple(df for df, at in frames if at is None),
        summary=summary,
    )


def _read(
    spark: SparkSession,
    files: DataFrame,
    root: str,
    pattern: str,
    whole: DataFrame | None,
    every: bool,
    known: DataFrame | None,
    keep: str | None,
) -> tuple[Frames, LandingSummary]:
    """The scans of the files inside: as few as their schemas and places of the period allow."""
    summary, first, last, modified = _summarise(spark, files, root, pattern)
    if whole is not None and summary.files_without_period == 0 and len(summary.slices) == 1:
        return [(whole, next(iter(summary.slices)))], summary
    places = _Places(spark, files, summary, root, pattern, first, last, _settled(modified))
    disagree = every and whole is None
    frames = None
    if keep is None and not disagree:
        frames = places.if_all_agree(whole)
    if frames is None:
        frames = _scan_files(spark, places, disagree, known, keep)
    return frames, summary


def in_period(period: Period | None) -> Column:
    """Whether a listed file is of the months asked for; one without a month always is."""
    if period is None:
        return F.lit(True)
    undated = F.col("year").isNull() | F.col("month").isNull()
    return undated | period.holds(F.col("year"), F.col("month"))


@dataclass(frozen=True)
class _Places:
    """The listed files, those ``inside`` marked, and how to name them."""

    spark: SparkSession
    files: DataFrame
    summary: LandingSummary
    root: str
    pattern: str
    first: str
    last: str
    settled: dict[str, str]  # reader options that leave out files which came after the listing

    @property
    def _at(self) -> Column:
        """The place of the period, none for files without one."""
        dated = F.col("year").isNotNull() & F.col("month").isNotNull()
        return F.when(dated, slice_of(F.col("uri"), self.pattern, self.summary.anchor)).alias("at")

    @property
    def asked(self) -> DataFrame:
        """Files inside, with the place of the period."""
        columns = ("path", "bytes", "modified", "year", "month", "drop")
        return self.files.where("inside").select(*columns, self._at)

    def names(self, grouped: DataFrame) -> dict[tuple[int, PeriodSlice | None], list[str]]:
        """What to read for each schema and place of ``grouped`` (path, schema, at): the highest folders
        that hold nothing else, and single files where a folder holds several kinds."""
        inside = grouped.select(F.col("path").alias("__path"), F.struct("schema", "at").alias("kind"))
        kinds = self.files.select("path").join(inside, F.col("path") == F.col("__path"), "left").drop("__path")
        return self._tops(kinds)

    def _tops(self, kinds: DataFrame) -> dict[tuple[int, PeriodSlice | None], list[str]]:
        if self.summary.files <= _FEW:
            kinds = kinds.repartition(1)  # no exchange from here on
        # A root that is a pattern may have neighbours in its folders that are not asked for.
        if re.search(r"[*?\[{]", self.root):
            tops = kinds.where("kind IS NOT NULL").select("kind", F.col("path").alias("top"))
        else:
            shared = len(posixpath.commonprefix([self.first.split("/"), self.last.split("/")]))
            depths = F.sequence(F.lit(shared), F.size(F.split("path", "/")))
            above = kinds.withColumn("depth", F.explode(depths))
            above = above.withColumn("name", F.expr("substring_index(path, '/', depth)"))
            pure = above.groupBy("name").agg(
                F.min("kind").alias("low"),
                F.max("kind").alias("high"),
                F.count_if(F.col("kind").isNull()).alias("others"),
            )
            pure = pure.where("others = 0 AND low <=> high").select("name")
            tops = above.join(pure, "name").groupBy("path", "kind").agg(F.min_by("name", "depth").alias("top"))
        found: dict[tuple[int, PeriodSlice | None], list[str]] = {}
        for row in _listing(self.spark, tops.select("kind", "top").distinct()):
            at = row["kind"]["at"]
            key = (row["kind"]["schema"], PeriodSlice(**at.asDict()) if at else None)
            found.setdefault(key, []).append(row["top"])
        ordered = {kind: sorted(paths) for kind, paths in found.items()}
        return dict(sorted(ordered.items(), key=lambda entry: entry[1]))

    def if_all_agree(self, whole: DataFrame | None) -> Frames | None:
        """One scan per place of the period, under the merged schema of its files; None if the types
        of one disagree. ``whole`` is a scan of the root under a schema that all files agree on."""
        kind = F.struct(F.lit(0).alias("schema"), self._at)
        frames: Frames = []
        for (_, at), paths in self._tops(self.files.select("path", F.when(F.col("inside"), kind).alias("kind"))).items():
            if whole is not None and at is not None:
                frames.append((_reader_of(self.spark, whole.schema, paths, self.settled), at))
                continue
            merged = _merged(self.spark, [_literal_path(p) for p in paths], self.settled)
            if merged is None:
                return None
            frames.append((merged, at))
        return frames


def _settled(last: datetime) -> dict[str, str]:
    after = (last + timedelta(milliseconds=1)).astimezone(timezone.utc)
    return {"timeZone": "UTC", "modifiedBefore": after.strftime("%Y-%m-%dT%H:%M:%S.%f")}


def _scan_files(
    spark: SparkSession,
    places: _Places,
    disagree: bool,
    known: DataFrame | None,
    keep: str | None,
) -> Frames:
    """One scan per distinct schema and place of the period; no place for files without period.

    A constant number of jobs, and one for each distinct schema, however many files there are and
    in whatever order their types change.
    """
    asked, tasks = places.asked, spark.sparkContext.defaultParallelism
    if known is None:
        read = fingerprinted(asked, tasks)
    else:
        state = known.select("path", "bytes", "modified", FINGERPRINT)
        both = asked.join(state, ["path", "bytes", "modified"], "left")
        new = both.where(F.col(FINGERPRINT).isNull()).drop(FINGERPRINT)
        old = both.where(F.col(FINGERPRINT).isNotNull()).withColumn(FAULT, F.lit(None).cast("string"))
        read = fingerprinted(new, tasks).unionByName(old)
    if keep is not None:
        read.write.parquet(keep)
        return _frames(spark, places, spark.read.schema(read.schema).parquet(keep), disagree)
    read = read.persist(StorageLevel.MEMORY_AND_DISK)
    try:
        return _frames(spark, places, read, disagree)
    finally:
        read.unpersist()


def _frames(spark: SparkSession, places: _Places, read: DataFrame, disagree: bool) -> Frames:
    kinds = _listing(
        spark,
        read.groupBy(FINGERPRINT, FAULT).agg(
            F.min("path").alias("path"), F.max("modified").alias("modified")
        ),
    )
    for kind in kinds:
        if kind[FAULT] == NO_CLIENT:
            return _scan_drops(spark, read, disagree)
        if kind[FAULT] is not None:
            raise ContractError(f"CANNOT_READ_FILE_FOOTER {kind['path']}: {kind[FAULT]}")
    with ThreadPoolExecutor(_PROBES_AT_ONCE) as pool:
        of_one = pool.map(lambda k: _reader(spark).parquet(_literal_path(k["path"])).schema, kinds)
        schemas = _agreeing_kinds([(k[FINGERPRINT], schema) for k, schema in zip(kinds, of_one)])
    number = reduce(
        lambda rest, kind: F.when(F.col(FINGERPRINT).isin(kind[1][1]), kind[0]).otherwise(rest),
        enumerate(schemas),
        F.lit(None).cast("int"),
    )
    names = places.names(read.select("path", "at", number.alias("schema")))
    return [
        (_reader_of(spark, schemas[number][0], paths, places.settled), at)
        for (number, at), paths in names.items()
    ]


def _agreeing_kinds(
    kinds: list[tuple[str, T.StructType]],
) -> list[tuple[T.StructType, list[str]]]:
    """Schemas that one scan can read put together, each with its fingerprints."""
    groups: list[tuple[T.StructType, list[str]]] = []
    for fingerprint, schema in sorted(kinds):
        for i, (have, members) in enumerate(groups):
            both = _agreeing(have, schema)
            if both is not None:
                groups[i] = (both, [*members, fingerprint])
                break
        else:
            groups.append((schema, [fingerprint]))
    return groups


def _reader_of(
    spark: SparkSession, schema: T.StructType, paths: list[str], settled: dict[str, str]
) -> DataFrame:
    """Scan of the named files and folders, without files that came after the listing."""
    return _reader(spark).options(**settled).schema(schema).parquet(*map(_literal_path, paths))


def _scan_drops(spark: SparkSession, files: DataFrame, disagree: bool) -> Frames:
    """The same where tasks cannot open the files: Spark merges footers of pieces of the drops."""
    drops: dict[PeriodSlice | None, list[str]] = {}
    for row in _listing(spark, files.select("drop", "at").distinct()):
        at = PeriodSlice(**row["at"].asDict()) if row["at"] else None
        drops.setdefault(at, []).append(row["drop"])
    return [
        (frame, at)
        for at, paths in drops.items()
        for frame, _ in schema_groups(spark, paths, disagree and len(drops) == 1)
    ]


def _with_period(
    df: DataFrame, contract: TableContract, at: PeriodSlice
) -> DataFrame:
    period = period_by_slice(F.col("_metadata.file_path"), at)
    added = [p.alias(n) for p, n in zip(period, contract.partition_by)]
    if contract.file_key:
        added.append(file_key().alias(contract.file_key))
    kept = [F.col(quoted_column(c)) for c in df.columns if c.lower() not in contract.derived]
    return df.select(*kept, *added)
