"""Gold: grouped means stored as tables."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sedimenta.contracts import quoted
from sedimenta.functions.period import Period
from sedimenta.operators.layers import write_layer
from sedimenta.operators.materialize import MaterializeMode, materialize
from sedimenta.sources.catalog import ensure_database


@dataclass(frozen=True)
class GoldResult:
    """A result table, computed by ``query`` from the unified table."""

    table: str
    location: str
    query: Callable[[DataFrame], DataFrame]
    order_by: tuple[str, ...]

    @property
    def folders(self) -> tuple[str, ...]:
        return (self.location,)

    def rows(self, spark: SparkSession, silver: DataFrame, months: Period | None) -> DataFrame:
        return self.query(silver)


@dataclass(frozen=True)
class IncrementalResult:
    """A result table put together from stored states, of which only changed months are computed.

    ``states`` gives the states of the unified table's rows, with its partition columns among
    them; ``result`` the result from the states of all months. A month that has lost all its rows
    keeps its states until all are computed anew.
    """

    table: str
    location: str
    states: Callable[[DataFrame], DataFrame]
    result: Callable[[DataFrame], DataFrame]
    order_by: tuple[str, ...]
    partition_by: tuple[str, str] = ("ano", "mes")

    @property
    def state_folder(self) -> str:
        return f"{self.location.rstrip('/')}_states"

    @property
    def folders(self) -> tuple[str, ...]:
        return (self.location, self.state_folder)

    def rows(self, spark: SparkSession, silver: DataFrame, months: Period | None) -> DataFrame:
        """The result after the states of ``months``, or of all, have been replaced."""
        if months is not None and self._stored(spark) is None:
            months = None
        if months is not None:
            silver = silver.where(months.holds(*(F.col(c) for c in self.partition_by)))
        mode = "replace_all" if months is None else "replace_partitions"
        write_layer(self.states(silver), self.state_folder, self.partition_by, mode)
        return self.result(self._stored(spark))

    def _stored(self, spark: SparkSession) -> DataFrame | None:
        try:
            return spark.read.parquet(self.state_folder)
        except AnalysisException as error:
            if error.getCondition() in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA"):
                return None
            raise


def run_gold(
    spark: SparkSession,
    results: Sequence[GoldResult | IncrementalResult],
    silver_table: str,
    mode: MaterializeMode = "refresh",
    months: Period | None = None,
) -> dict[str, DataFrame]:
    """Store every result; returns them by table name. ``months`` are those of Silver that changed."""
    stored = {}
    for result in results:
        if "." in result.table:
            ensure_database(spark, result.table.rsplit(".", 1)[0])
        rows = result.rows(spark, spark.table(quoted(silver_table)), months)
        stored[result.table] = materialize(rows, result.table, result.location, mode)
    return stored
