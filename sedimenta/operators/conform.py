"""Bring a DataFrame to a table contract."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass
from functools import reduce
from typing import Literal

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sedimenta.contracts import ContractError, TableContract, quoted_column
from sedimenta.functions.casts import as_common, castable, common_type, convert, may_lose

Extras = Literal["keep", "drop"]

_LOST = "__lost_"


def _by_lower_name(df: DataFrame) -> dict[str, T.StructField]:
    found: dict[str, T.StructField] = {}
    for field in df.schema.fields:
        if field.name.lower() in found:
            raise ContractError(f"columns differ in letter case only: {field.name}")
        found[field.name.lower()] = field
    return found


def _projection(
    df: DataFrame, columns: T.StructType, extras: Extras, with_lost: bool
) -> list[Column]:
    found = _by_lower_name(df)
    declared = {f.name.lower() for f in columns.fields}
    out, lost = [], []
    for field in columns.fields:
        have = found.get(field.name.lower())
        if have is None:
            out.append(F.lit(None).cast(field.dataType).alias(field.name))
            continue
        source = F.col(quoted_column(have.name))
        if not castable(have.dataType, field.dataType):
            raise ContractError(
                f"{field.name} comes as {have.dataType.simpleString()}, "
                f"declared {field.dataType.simpleString()}"
            )
        value = convert(source, have.dataType, field.dataType)
        out.append(value.alias(field.name))
        if with_lost and may_lose(have.dataType, field.dataType):
            lost.append((source.isNotNull() & value.isNull()).alias(_LOST + field.name))
    if extras == "keep":
        out += [F.col(quoted_column(f.name)) for low, f in found.items() if low not in declared]
    return out + lost


def conform(df: DataFrame, columns: T.StructType, extras: Extras = "keep") -> DataFrame:
    """Declared columns first, in declared order and type; a missing one is a typed NULL.

    Source columns are found without regard to letter case. Values that do not fit become
    NULL. Undeclared columns follow (``keep``) or go (``drop``). One projection, no chain.
    """
    return df.select(*_projection(df, columns, extras, with_lost=False))


def unfit_columns(df: DataFrame, columns: T.StructType) -> Column | None:
    """Names of the columns whose value in a row does not fit; None where every cast holds all values."""
    names = []
    found = _by_lower_name(df)
    for field in columns.fields:
        have = found.get(field.name.lower())
        if have is not None and may_lose(have.dataType, field.dataType):
            source = F.col(quoted_column(have.name))
            lost = source.isNotNull() & convert(source, have.dataType, field.dataType).isNull()
            names.append(F.when(lost, F.lit(field.name)))
    return F.array_compact(F.array(*names)) if names else None


@dataclass(frozen=True)
class Conformed:
    """Rows at the contract, plus one boolean per cast that may have lost the value."""

    rows: DataFrame
    lost_flags: tuple[str, ...]

    def lost_counts(self) -> list[Column]:
        """One count per flagged column, named by the column."""
        return [
            F.count_if(F.col(quoted_column(c))).alias(c[len(_LOST) :]) for c in self.lost_flags
        ]


def conform_all(
    groups: Sequence[DataFrame], contract: TableContract, extras: Extras = "keep"
) -> Conformed:
    """Conform each schema group and put the groups together by column name.

    The groups carry the partition columns already. An undeclared column that comes in several
    types gets one that holds the values of all, see :func:`common_type`.
    """
    columns = T.StructType(
        [*contract.columns.fields]
        + [T.StructField(c, T.IntegerType()) for c in contract.partition_by]
        + ([T.StructField(contract.file_key, T.LongType())] if contract.file_key else [])
    )
    parts = [df.select(*_projection(df, columns, extras, with_lost=True)) for df in groups]
    # Declared columns and flags agree already; what is left to put together is undeclared.
    shared = widened([part.schema for part in parts])
    rows = reduce(
        DataFrame.unionByName,
        (part.select(*at_schema(part.schema, shared, lambda c: F.col(quoted_column(c)))) for part in parts),
    )
    flags = tuple(c for c in rows.columns if c.startswith(_LOST))
    return Conformed(rows, flags)


def widened(schemas: Sequence[T.StructType]) -> T.StructType:
    """All columns of the schemas, found without regard to letter case, each in one type for all."""
    fields: dict[str, T.StructField] = {}
    for field in (f for schema in schemas for f in schema.fields):
        have = fields.get(field.name.lower())
        if have is None:
            fields[field.name.lower()] = T.StructField(field.name, field.dataType)
        else:
            both = common_type(have.dataType, field.dataType)
            fields[field.name.lower()] = T.StructField(have.name, both)
    return T.StructType(list(fields.values()))


def at_schema(
    have: T.StructType, want: T.StructType, column_of: Callable[[str], Column]
) -> list[Column]:
    """Columns of a widened schema, from those of one of its parts; a missing one is NULL."""
    found = {f.name.lower(): f for f in have.fields}
    out = []
    for field in want.fields:
        source = found.get(field.name.lower())
        if source is None:
            value = F.lit(None).cast(field.dataType)
        else:
            value = as_common(column_of(source.name), source.dataType, field.dataType)
        out.append(value.alias(field.name))
    return out
