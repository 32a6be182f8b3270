"""Partitioned Parquet layers: three rerun semantics, reprocessing, CSV export."""

from __future__ import annotations

import posixpath
from collections.abc import Mapping, Sequence
from typing import Literal, get_args

from pyspark.sql import DataFrame, SparkSession

from sedimenta.contracts import quoted, quoted_column
from sedimenta.session import session_conf

WriteMode = Literal["replace_partitions", "replace_all", "append"]

COMPRESSION = "snappy"

MB = 1024 * 1024

# Names of one object store's connectors.
_SAME_STORE = {"s3": "s3a", "s3n": "s3a", "wasb": "abfs", "wasbs": "abfs", "abfss": "abfs"}

# Settings of a layer write, each only where the session has no value of its own.
# Up to 16 partitions a task keeps one open file each and needs no sort; beyond, it sorts the
# rest by partition. What a task buffers is bounded by its input split.
_WRITE_SETTINGS = {
    "spark.sql.maxConcurrentOutputFileWriters": "16",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": str(256 * MB),
}


def check_mode(mode: str) -> None:
    if mode not in get_args(WriteMode):
        raise ValueError(f"write mode {mode!r}: expected one of {', '.join(get_args(WriteMode))}")


def qualified(location: str) -> str:
    """One spelling of a location: no ``.`` and ``..``, one name for each store.

    A path without scheme is taken for one of the local file system; on a cluster whose default
    is another one, name the scheme.
    """
    scheme, found, rest = location.partition(":/")
    if not found or "/" in scheme:
        scheme, rest = "file", location
    host, path = "", "/" + rest.lstrip("/") if scheme == "file" else rest
    if scheme != "file" and rest.startswith("/"):
        host, _, path = rest[1:].partition("/")
    path = posixpath.normpath("/" + path.lstrip("/"))
    return f"{_SAME_STORE.get(scheme, scheme)}://{host}{path}".rstrip("/")


def distinct_locations(*locations: str) -> None:
    """Raise if one location equals or contains another: overwriting would eat the input."""
    slashed = [qualified(location) + "/" for location in locations]
    for i, a in enumerate(slashed):
        for b in slashed[i + 1 :]:
            if a.startswith(b) or b.startswith(a):
                raise ValueError(f"locations overlap: {a} and {b}")


def compacted(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Shuffle rows of the same keys together; a large group still spreads over tasks.

    For input made of many small files only. A rebalance hint lets the runtime split
    groups above the advisory partition size, so a hot month is never one task; that needs
    adaptive execution.
    """
    if df.sparkSession.conf.get("spark.sql.adaptive.enabled") != "true":
        raise RuntimeError("compaction needs spark.sql.adaptive.enabled: a month would be one task")
    return df.hint("rebalance", *keys)


def write_layer(
    df: DataFrame,
    location: str,
    partition_by: Sequence[str],
    mode: WriteMode = "replace_partitions",
    split: int | None = None,
) -> None:
    """Write a layer without a shuffle.

    ``replace_partitions``  replaces the partitions present in ``df``, leaves the others
    ``replace_all``         replaces the whole location
    ``append``              adds files; a rerun doubles its rows

    ``split`` sets the input per task in bytes, unless the session sets it.
    """
    check_mode(mode)
    writer = (
        df.write.partitionBy(*partition_by)
        .option("compression", COMPRESSION)
        .option("partitionOverwriteMode", "dynamic" if mode == "replace_partitions" else "static")
        .mode("append" if mode == "append" else "overwrite")
    )
    settings = dict(_WRITE_SETTINGS)
    if split is not None:
        settings["spark.sql.files.maxPartitionBytes"] = str(split)
    spark = df.sparkSession
    unset = {key: value for key, value in settings.items() if spark.conf.get(key, None) is None}
    with session_conf(spark, unset):
        writer.parquet(location)


def reprocess_partition(
    spark: SparkSession, table: str, partition: Mapping[str, int], df: DataFrame
) -> None:
    """Replace exactly one partition of a table by ``df``; the other partitions stay."""
    keys = {k.lower() for k in partition}
    columns = [c for c in spark.table(table).columns if c.lower() not in keys]
    spec = ", ".join(f"{quoted_column(k)} = {int(v)}" for k, v in partition.items())
    rows = df.select(*(quoted_column(c) for c in columns))
    spark.sql(
        f"INSERT OVERWRITE TABLE {quoted(table)} PARTITION ({spec}) SELECT * FROM {{rows}}",
        rows=rows,
    )


def export_csv(df: DataFrame, location: str, order_by: Sequence[str]) -> None:
    """Ordered CSV with a header row.

    A result that fits one shuffle partition, as grouped means do, becomes one file; a
    larger one becomes several files, in order by name, with no task holding all rows.
    """
    df.orderBy(*order_by).write.mode("overwrite").option("header", True).csv(location)
