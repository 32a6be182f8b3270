"""Store a query result as a table, once or with refresh."""

from __future__ import annotations

from typing import Literal

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession

from sedimenta.contracts import ContractError, quoted, quoted_column
from sedimenta.operators.layers import COMPRESSION, qualified
from sedimenta.sources.catalog import table_location

MaterializeMode = Literal["once", "refresh"]


def _holds_files(spark: SparkSession, location: str) -> bool:
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true")
    try:
        return not files.load(location).select("path").isEmpty()
    except AnalysisException as error:
        if error.getCondition() == "PATH_NOT_FOUND":
            return False
        raise


def materialize(
    df: DataFrame, table: str, location: str, mode: MaterializeMode = "refresh"
) -> DataFrame:
    """Result table of ``df`` at ``location``.

    ``once``     does nothing when the table exists
    ``refresh``  replaces its rows

    Creating the table refuses a location that already holds files. A table that exists
    elsewhere or has other columns is refused in both modes.
    """
    spark = df.sparkSession
    if mode not in ("once", "refresh"):
        raise ValueError(f"mode {mode!r}: expected once or refresh")
    if not spark.catalog.tableExists(quoted(table)):
        if _holds_files(spark, location):
            raise FileExistsError(f"{location} holds files but is not table {table}")
        (
            df.write.format("parquet")
            .option("compression", COMPRESSION)
            .option("path", location)
            .saveAsTable(quoted(table))
        )
        return spark.table(quoted(table))
    have = table_location(spark, table)
    if qualified(have) != qualified(location):
        raise ContractError(f"{table} is at {have}, not at {location}")
    columns = spark.table(quoted(table)).columns
    if sorted(c.lower() for c in columns) != sorted(c.lower() for c in df.columns):
        raise ContractError(f"{table} has the columns {columns}, the result {df.columns}")
    if mode == "refresh":
        df.select(*map(quoted_column, columns)).write.insertInto(quoted(table), overwrite=True)
    return spark.table(quoted(table))
