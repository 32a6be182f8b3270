"""Silver: Bronze tables -> one unified table."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

from sedimenta.contracts import TableContract, quoted
from sedimenta.functions.period import Period
from sedimenta.operators.layers import MB, WriteMode, write_layer
from sedimenta.operators.unify import SourceMapping, map_source, unify
from sedimenta.plans.bronze import register
from sedimenta.sources.catalog import check_table, known_months, read_table

# Silver reads about a third of a Bronze file's columns; a task takes a whole large file, to
# write one of 128 MB or more.
_SPLIT = 512 * MB


class PipelineError(RuntimeError):
    """A step could not run completely, so nothing after it was replaced."""


@dataclass(frozen=True)
class SilverLayer:
    """The unified table and the mapping of each source table."""

    contract: TableContract
    location: str
    sources: tuple[SourceMapping, ...]


def unified(
    spark: SparkSession, layer: SilverLayer, period: Period | None = None
) -> DataFrame:
    """Rows of all sources under the unified columns; raises unless every source is there."""
    missing = [s.source for s in layer.sources if not spark.catalog.tableExists(quoted(s.source))]
    if missing:
        raise PipelineError(f"{layer.contract.name}: no table {', '.join(missing)}")
    return unify(
        [
            map_source(
                read_table(spark, s.source, period, layer.contract.partition_by), s, layer.contract
            )
            for s in layer.sources
        ]
    )


def run_silver(
    spark: SparkSession,
    layer: SilverLayer,
    mode: WriteMode = "replace_all",
    period: Period | None = None,
) -> None:
    """Write the unified table and register its partitions.

    No shuffle: every file holds rows of one source, so a filter on the source skips whole
    files by their statistics. With ``period`` only those months are read; combine it with
    ``replace_partitions``, or the other months are gone.
    """
    if period is not None and mode == "replace_all":
        raise ValueError("a range of months with replace_all would drop all other months")
    check_table(spark, layer.contract, layer.location)
    rows = unified(spark, layer, period)
    write_layer(rows, layer.location, layer.contract.partition_by, mode, _SPLIT)
    months = _months(spark, layer, period)
    register(spark, layer.contract, layer.location, months, replaced_all=mode == "replace_all")


def _months(
    spark: SparkSession, layer: SilverLayer, period: Period | None
) -> frozenset[tuple[int, int]] | None:
    """Months of the source tables, as the catalog has them; None if a mapping makes its own."""
    partition_by = layer.contract.partition_by
    if any(s.columns.get(c) != c for s in layer.sources for c in partition_by):
        return None
    months = frozenset().union(*(known_months(spark, s.source) for s in layer.sources))
    return months if period is None else frozenset(m for m in months if period.has(*m))
