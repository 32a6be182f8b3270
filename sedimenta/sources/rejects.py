"""Rows that a load could not place, kept as they came.

Each load has its own folder, ``load=<id>``; a row is a struct with the columns and types of its
file, beside the path of the file and the reason.
"""

from __future__ import annotations

import re
from collections.abc import Sequence
from functools import reduce

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from sedimenta.contracts import quoted_column
from sedimenta.operators.conform import at_schema, widened
from sedimenta.operators.layers import COMPRESSION

ROW, SOURCE_PATH, REASON, LOAD = "row", "source_path", "reason", "load"


def _folder(folder: str, load: str) -> str:
    return f"{folder.rstrip('/')}/{LOAD}={load}"


def keep(groups: Sequence[DataFrame], reason: Column, folder: str, load: str, label: str) -> int:
    """Write the rows of each scan under the load; returns how many there were."""
    rows = 0
    for number, df in enumerate(groups):
        path = F.col("_metadata.file_path").alias(SOURCE_PATH)
        row = F.struct(*(F.col(quoted_column(c)) for c in df.columns)).alias(ROW)
        seen = Observation()
        kept = df.select(path, reason.alias(REASON), row).observe(seen, F.count("*").alias("rows"))
        target = f"{_folder(folder, load)}/{label}-{number}"
        kept.write.option("compression", COMPRESSION).parquet(target)
        rows += seen.get["rows"]
    return rows


def _scans(spark: SparkSession, place: str) -> list[str]:
    """Folders that hold one scan's rows each: few for each load."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true")
    files = files.option("pathGlobFilter", "*.parquet")
    try:
        found = files.load(place)
    except AnalysisException as error:
        if error.getCondition() == "PATH_NOT_FOUND":
            return []
        raise
    return sorted(r[0] for r in found.select(F.regexp_extract("path", "^(.*)/", 1)).distinct().collect())


def rejected(spark: SparkSession, folder: str, load: str | None = None) -> DataFrame | None:
    """Rejected rows of one load or of all: ``load``, ``source_path``, ``reason`` and ``row``.

    Files of different columns give one struct with all of them, each in a type that holds all its
    values. None if there is no row.
    """
    parts = []
    for scan in _scans(spark, _folder(folder, load) if load else folder):
        of = re.search(rf"/{LOAD}=([^/]+)/", scan)
        parts.append(spark.read.parquet(scan).withColumn(LOAD, F.lit(of[1])))
    if not parts:
        return None
    shared = widened([df.schema[ROW].dataType for df in parts])

    def shaped(df: DataFrame) -> DataFrame:
        fields = at_schema(df.schema[ROW].dataType, shared, lambda c: F.col(ROW).getField(c))
        return df.select(LOAD, SOURCE_PATH, REASON, F.struct(*fields).alias(ROW))

    return reduce(DataFrame.unionByName, map(shaped, parts))


def clear(spark: SparkSession, folder: str, load: str) -> None:
    """Forget the rejected rows of one load, once they are dealt with."""
    for scan in _scans(spark, _folder(folder, load)):
        rows = spark.read.parquet(scan)
        empty = spark.createDataFrame([], rows.schema)
        empty.write.mode("overwrite").parquet(scan)
