"""Contracts, mappings and landing drops for ``lineitem`` and ``events``."""

from __future__ import annotations

import uuid
from collections.abc import Callable
from functools import cached_property

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sedimenta.contracts import TableContract
from sedimenta.operators.unify import SourceMapping
from sedimenta.plans.bronze import Dataset, ingest
from sedimenta.plans.silver import SilverLayer, run_silver
from sedimenta.session import shared_folder
from sedimenta.sources.catalog import ensure_database

PERIOD = ("year", "month")

LINEITEM_COLUMNS = T.StructType(
    [
        T.StructField("l_orderkey", T.LongType()),
        T.StructField("l_partkey", T.LongType()),
        T.StructField("l_suppkey", T.LongType()),
        T.StructField("l_linenumber", T.IntegerType()),
        T.StructField("l_quantity", T.DoubleType()),
        T.StructField("l_extendedprice", T.DoubleType()),
        T.StructField("l_discount", T.DoubleType()),
        T.StructField("l_tax", T.DoubleType()),
        T.StructField("l_returnflag", T.StringType()),
        T.StructField("l_linestatus", T.StringType()),
        T.StructField("l_shipdate", T.TimestampNTZType()),
    ]
)
EVENTS_COLUMNS = T.StructType(
    [
        T.StructField("event_id", T.LongType()),
        T.StructField("user_id", T.LongType()),
        T.StructField("ts", T.TimestampNTZType()),
        T.StructField("event_type", T.StringType()),
        T.StructField("value", T.DoubleType()),
        T.StructField("props", T.StringType()),
    ]
)
UNIFIED_COLUMNS = T.StructType(
    [
        T.StructField("provider_id", T.LongType()),
        T.StructField("quantity", T.IntegerType()),
        T.StructField("amount", T.DoubleType()),
        T.StructField("start_ts", T.TimestampNTZType()),
        T.StructField("end_ts", T.TimestampNTZType()),
        T.StructField("kind", T.StringType()),
    ]
)

LINEITEM_MAPPING = {
    "provider_id": "l_suppkey",
    "quantity": "try_cast(l_quantity AS INT)",
    "amount": "l_extendedprice",
    "start_ts": "l_shipdate",
    "end_ts": "l_shipdate + make_dt_interval(l_linenumber)",
    "kind": "'lineitem'",
    "year": "year",
    "month": "month",
}
EVENTS_MAPPING = {
    "provider_id": "user_id",
    "quantity": "try_cast(value AS INT)",
    "amount": "value",
    "start_ts": "ts",
    "end_ts": "ts",
    "kind": "'events'",
    "year": "year",
    "month": "month",
}


def lineitem_contract(table: str, columns: T.StructType = LINEITEM_COLUMNS) -> TableContract:
    return TableContract(table, columns, PERIOD, "ingestion_ts", "l_shipdate")


def monthly_drop(prefix: str, time: str) -> Column:
    """Drop name of a row: ``prefix_YYYY-MM.parquet``."""
    return F.concat(F.lit(f"{prefix}_"), F.date_format(time, "yyyy-MM"), F.lit(".parquet"))


def stage(df: DataFrame, landing: str, drop: Column, mode: str = "errorifexists") -> None:
    """Write rows as landing drops, one directory of part files per drop name."""
    (
        df.withColumn("drop", drop)
        .hint("rebalance", "drop")
        .write.mode(mode)
        .partitionBy("drop")
        .parquet(landing)
    )


class Lake:
    """Landing drops, Bronze and Silver of one data folder; each is built on first use."""

    def __init__(self, spark: SparkSession, sf_dir: str) -> None:
        self.spark = spark
        self.sf_dir = sf_dir
        self.root = shared_folder(spark, "lake")
        self._landings: dict[str, str] = {}
        self.database = f"lake_{uuid.uuid4().hex[:8]}"
        ensure_database(spark, self.database, f"{self.root}/database")

    def table(self, name: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.sf_dir}/{name}.parquet")

    def fresh(self, label: str) -> tuple[str, str]:
        """A new folder and a new table name."""
        mark = uuid.uuid4().hex[:8]
        return f"{self.root}/{label}_{mark}", f"{self.database}.{label}_{mark}"

    def lineitem_dataset(self, label: str, landing: str | None = None) -> Dataset:
        """Staged lineitem on its way to a new Bronze table."""
        location, table = self.fresh(label)
        return Dataset(lineitem_contract(table), landing or self.lineitem_landing, location)

    def landing(self, label: str, write: Callable[[str], None]) -> str:
        """Folder of landing drops; ``write`` fills it on the first call for the label."""
        if label not in self._landings:
            folder = f"{self.root}/landing/{label}"
            write(folder)
            self._landings[label] = folder
        return self._landings[label]

    @property
    def lineitem_landing(self) -> str:
        return self.landing(
            "lineitem",
            lambda to: stage(self.table("lineitem"), to, monthly_drop("lineitem", "l_shipdate")),
        )

    @property
    def events_landing(self) -> str:
        return self.landing(
            "events", lambda to: stage(self.table("events"), to, monthly_drop("events", "ts"))
        )

    def events_dataset(self, label: str) -> Dataset:
        """Staged events on their way to a new Bronze table."""
        location, table = self.fresh(label)
        contract = TableContract(table, EVENTS_COLUMNS, PERIOD, "ingestion_ts", "ts")
        return Dataset(contract, self.events_landing, location)

    def silver_layer(self, datasets: tuple[Dataset, Dataset]) -> SilverLayer:
        location, table = self.fresh("trips")
        lineitem, events = datasets
        return SilverLayer(
            TableContract(table, UNIFIED_COLUMNS, PERIOD, event_time="start_ts"),
            location,
            (
                SourceMapping(lineitem.contract.name, LINEITEM_MAPPING),
                SourceMapping(events.contract.name, EVENTS_MAPPING),
            ),
        )

    @cached_property
    def bronze(self) -> tuple[Dataset, Dataset]:
        datasets = (self.lineitem_dataset("lineitem"), self.events_dataset("events"))
        for dataset in datasets:
            ingest(self.spark, dataset)
        return datasets

    @cached_property
    def silver(self) -> SilverLayer:
        layer = self.silver_layer(self.bronze)
        run_silver(self.spark, layer)
        return layer

    def silver_table(self) -> DataFrame:
        return self.spark.table(self.silver.contract.name)


_lakes: dict[tuple[str, str], Lake] = {}


def lake(spark: SparkSession, sf_dir: str) -> Lake:
    """The lake of this application and data folder."""
    key = (spark.sparkContext.applicationId, sf_dir.rstrip("/"))
    if key not in _lakes:
        _lakes[key] = Lake(spark, key[1])
    return _lakes[key]
