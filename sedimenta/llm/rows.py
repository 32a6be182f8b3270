"""Carry whole input rows through an operator, whatever their columns are called."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from contextlib import contextmanager

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sedimenta.session import session_conf, shared_folder

ROW = "r"
#: Spark's own setting: shuffle files go when the query ends, not when the driver's JVM collects garbage.
CLEANED = {"spark.sql.classic.shuffleDependency.fileCleanup.enabled": "true"}


def field(name: str) -> Column:
    """One input column of a packed row."""
    return F.col(ROW).getField(name)


def quoted(name: str) -> Column:
    return F.col("`" + name.replace("`", "``") + "`")


def packed(df: DataFrame, *new: Column) -> DataFrame:
    """Input rows as one struct column, so that no input name can clash with those of an operator."""
    columns = [
        (quoted(f.name).cast("string") if isinstance(f.dataType, T.NullType) else quoted(f.name)).alias(f.name)
        for f in df.schema.fields
    ]
    return df.select(F.struct(*columns).alias(ROW), *new)


def unpacked(df: DataFrame, **new: Column) -> DataFrame:
    """Input columns again, then the new ones; a new one takes the place of an input column of its name,
    in whatever letter case."""
    taken = {name.lower() for name in new}
    fields = [f.name for f in df.schema[ROW].dataType.fields if f.name.lower() not in taken]
    return df.select(
        *[field(name).alias(name) for name in fields], *[c.alias(name) for name, c in new.items()]
    )


def written(df: DataFrame, label: str, path: str | None = None, **options: str) -> DataFrame:
    """The rows as a table in the folder that all executors share: lineage ends here.

    What was shuffled for it is removed as soon as it is written. ``options`` are those of the writer.
    """
    spark: SparkSession = df.sparkSession
    path = path or shared_folder(spark, label)
    with session_conf(spark, CLEANED):
        df.write.options(compression="zstd", **options).parquet(path)
    return spark.read.schema(df.schema).parquet(path)


@contextmanager
def scratch(spark: SparkSession) -> Iterator[Callable[..., DataFrame]]:
    """``written`` for tables that nothing reads after the block: then they are emptied.

    What outlives the block is written inside it, or does not read these tables.
    """
    paths: list[str] = []

    def kept(df: DataFrame, label: str, **options: str) -> DataFrame:
        paths.append(shared_folder(spark, label))
        return written(df, label, paths[-1], **options)

    yield kept
    for path in paths:
        spark.range(0).write.mode("overwrite").parquet(path)


def staged(df: DataFrame, label: str) -> DataFrame:
    """Packed rows with a number ``row`` each, written once so that the numbers never change."""
    return written(packed(df, F.monotonically_increasing_id().alias("row")), label)
