"""Catalog side: databases, external tables, partition registration, table scans."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sedimenta.contracts import ContractError, TableContract, quoted, quoted_column
from sedimenta.functions.period import Period
from sedimenta.operators.layers import COMPRESSION, qualified


def _location(place: str) -> str:
    text = place.replace("\\", "\\\\").replace("'", "\\'")
    return f"LOCATION '{text}'"


def ensure_database(spark: SparkSession, name: str, location: str | None = None) -> None:
    """Create a database if it is not there, at the default place of the catalog or a given one."""
    place = f" {_location(location)}" if location else ""
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {quoted(name)}{place}")


def table_ddl(contract: TableContract, location: str) -> str:
    """CREATE statement of the external table behind a contract."""
    columns = ",\n  ".join(
        f"{quoted_column(f.name)} {f.dataType.simpleString()}"
        for f in contract.table_schema.fields
    )
    partitions = ", ".join(quoted_column(c) for c in contract.partition_by)
    return (
        f"CREATE TABLE IF NOT EXISTS {quoted(contract.name)} (\n  {columns}\n)\n"
        f"USING parquet\nOPTIONS (compression '{COMPRESSION}')\n"
        f"PARTITIONED BY ({partitions})\n{_location(location)}"
    )


def table_location(spark: SparkSession, table: str) -> str:
    """Where the files of an existing table are."""
    rows = spark.sql(f"DESCRIBE TABLE EXTENDED {quoted(table)}").where("col_name = 'Location'")
    return rows.select("data_type").first()[0]


def check_table(
    spark: SparkSession, contract: TableContract, location: str, grow: bool = False
) -> None:
    """Raise unless the table, if it exists, is at the location and has the contract's columns.

    ``grow`` adds columns that the table does not have yet.
    """
    if not spark.catalog.tableExists(quoted(contract.name)):
        return
    have = table_location(spark, contract.name)
    if qualified(have) != qualified(location):
        raise ContractError(f"{contract.name} is at {have}, not at {location}")
    schema = spark.table(quoted(contract.name)).schema
    known = {name.lower() for name in schema.names}
    missing = [f for f in contract.columns.fields if f.name.lower() not in known]
    if missing and grow:
        added = ", ".join(f"{quoted_column(f.name)} {f.dataType.simpleString()}" for f in missing)
        spark.sql(f"ALTER TABLE {quoted(contract.name)} ADD COLUMNS ({added})")
        schema = spark.table(quoted(contract.name)).schema
    contract.check(schema)


def ensure_table(spark: SparkSession, contract: TableContract, location: str) -> None:
    check_table(spark, contract, location)
    spark.sql(table_ddl(contract, location))


#: Table property: partitions are folders of single loads, switched after a check.
BY_LOAD = "partitions.by.load"


def _spec(partition_by: tuple[str, str], month: tuple[int, int]) -> str:
    parts = (f"{quoted_column(c)} = {int(v)}" for c, v in zip(partition_by, month, strict=True))
    return f"PARTITION ({', '.join(parts)})"


def partition_folder(location: str, partition_by: tuple[str, str], month: tuple[int, int]) -> str:
    return "/".join([location.rstrip("/"), *(f"{c}={v}" for c, v in zip(partition_by, month, strict=True))])


def known_months(spark: SparkSession, table: str) -> set[tuple[int, int]]:
    """Months that the catalog has of a table; no folder is listed."""
    rows = spark.sql(f"SHOW PARTITIONS {quoted(table)}").collect()
    values = [[part.partition("=")[2] for part in row[0].split("/")] for row in rows]
    return {(int(year), int(month)) for year, month in values if year.isdigit() and month.isdigit()}


def add_months(
    spark: SparkSession,
    contract: TableContract,
    months: Iterable[tuple[int, int]],
    location: str | None = None,
    only: bool = False,
) -> None:
    """Register the months that a write has touched, without listing the table's folders.

    ``location`` is the folder that holds the months, where it is not the table's own: months that the
    catalog knows are switched to it. ``only`` forgets all other months.
    """
    table, touched, known = quoted(contract.name), sorted(set(months)), None

    def place(month: tuple[int, int]) -> str:
        spec = _spec(contract.partition_by, month)
        if location is None:
            return spec
        return f"{spec} {_location(partition_folder(location, contract.partition_by, month))}"

    if location is not None or only:
        known = known_months(spark, contract.name)
    new = [m for m in touched if known is None or m not in known]
    if new:
        spark.sql(f"ALTER TABLE {table} ADD IF NOT EXISTS {' '.join(map(place, new))}")
    if location is not None:
        for month in touched:
            if month in known:
                folder = partition_folder(location, contract.partition_by, month)
                spec = _spec(contract.partition_by, month)
                spark.sql(f"ALTER TABLE {table} {spec} SET {_location(folder)}")
    if only:
        gone = sorted(known - set(touched))
        if gone:
            specs = ", ".join(_spec(contract.partition_by, m) for m in gone)
            spark.sql(f"ALTER TABLE {table} DROP IF EXISTS {specs}")
    spark.catalog.refreshTable(table)


def is_by_load(spark: SparkSession, table: str) -> bool:
    """Whether partitions of an existing table are folders of single loads."""
    if not spark.catalog.tableExists(quoted(table)):
        return False
    rows = spark.sql(f"SHOW TBLPROPERTIES {quoted(table)}").where(F.col("key") == BY_LOAD)
    return not rows.isEmpty()


def recover(spark: SparkSession, table: str, drop_missing: bool = False) -> None:
    """Register the partition directories of a table.

    ``drop_missing`` also forgets partitions whose directory is gone, as after a write that
    replaced the whole layer.
    """
    sync = " SYNC PARTITIONS" if drop_missing else ""
    spark.sql(f"MSCK REPAIR TABLE {quoted(table)}{sync}")
    spark.catalog.refreshTable(quoted(table))


def read_table(
    spark: SparkSession,
    table: str,
    period: Period | None = None,
    partition_by: tuple[str, str] = ("ano", "mes"),
) -> DataFrame:
    """A catalog table, within some months if given (prunes partitions)."""
    df = spark.table(quoted(table))
    if period is None:
        return df
    return df.where(period.holds(*(F.col(c) for c in partition_by)))
