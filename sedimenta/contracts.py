"""Table contracts: one declared schema per table drives casts, DDL and checks."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import types as T


class ContractError(ValueError):
    """Data or configuration does not fit a declared contract."""


def quoted_column(name: str) -> str:
    """One column name in backticks, dots included."""
    return "`" + name.replace("`", "``") + "`"


def quoted(name: str) -> str:
    """``db.table`` with every part in backticks."""
    return ".".join(quoted_column(part) for part in name.split("."))


@dataclass(frozen=True)
class TableContract:
    """Declared shape of one partitioned table.

    ``columns`` holds the business columns only. ``partition_by`` names the year and the
    month column, in that order; ``loaded_at`` names the load timestamp, or is None where
    the layer has none; ``event_time`` names the column that validation compares with the
    partition of a row; ``file_key`` names a column that tells from which landing file a row came,
    so that a file is appended once only.
    """

    name: str
    columns: T.StructType
    partition_by: tuple[str, str] = ("ano", "mes")
    loaded_at: str | None = None
    event_time: str | None = None
    file_key: str | None = None

    @property
    def derived(self) -> frozenset[str]:
        """Lower-cased names that the pipeline computes and never takes from a source."""
        return frozenset(c.lower() for c in (*self.partition_by, self.loaded_at, self.file_key) if c)

    @property
    def table_schema(self) -> T.StructType:
        """Business columns, load timestamp, file key, partition columns: the order of the DDL."""
        fields = list(self.columns.fields)
        if self.loaded_at:
            fields.append(T.StructField(self.loaded_at, T.TimestampType()))
        if self.file_key:
            fields.append(T.StructField(self.file_key, T.LongType()))
        fields += [T.StructField(c, T.IntegerType()) for c in self.partition_by]
        return T.StructType(fields)

    def check(self, schema: T.StructType) -> None:
        """Raise unless every declared column is in ``schema`` with the declared type."""
        found = {f.name.lower(): f.dataType for f in schema.fields}
        faults = []
        for field in self.table_schema.fields:
            have = found.get(field.name.lower())
            if have is None:
                faults.append(f"{field.name} is missing")
            elif have != field.dataType:
                faults.append(
                    f"{field.name} is {have.simpleString()}, declared {field.dataType.simpleString()}"
                )
        if faults:
            raise ContractError(f"{self.name}: " + "; ".join(faults))
