"""Map differently named sources onto one table."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sedimenta.contracts import ContractError, TableContract, quoted_column


@dataclass(frozen=True)
class SourceMapping:
    """Unified column -> SQL expression over the columns of one source.

    ``zone`` turns the source's times that carry a zone into wall-clock times there, before the
    expressions see them: for tables declared with ``timestamp``.
    """

    source: str
    columns: Mapping[str, str]
    zone: str | None = None


def map_source(df: DataFrame, mapping: SourceMapping, contract: TableContract) -> DataFrame:
    """Select, rename and tag the columns of one source; types must equal the contract."""
    names = [f.name for f in contract.table_schema.fields]
    unmapped = [n for n in names if n not in mapping.columns]
    if unmapped:
        raise ContractError(f"{mapping.source}: no expression for {', '.join(unmapped)}")
    out = _wall_clock(df, mapping.zone).select(*(F.expr(mapping.columns[n]).alias(n) for n in names))
    contract.check(out.schema)
    return out


def _wall_clock(df: DataFrame, zone: str | None) -> DataFrame:
    """Zoned times as times without zone, as a clock in ``zone`` showed them."""
    if zone is None:
        return df
    zoned = [f.name for f in df.schema.fields if isinstance(f.dataType, T.TimestampType)]
    return df.withColumns(
        {
            name: F.convert_timezone(None, F.lit(zone), F.col(quoted_column(name)).cast("timestamp_ntz"))
            for name in zoned
        }
    )


def unify(parts: Sequence[DataFrame]) -> DataFrame:
    """All rows of all parts by column name, duplicates included."""
    if not parts:
        raise ValueError("nothing to unify")
    return reduce(DataFrame.unionByName, parts)
