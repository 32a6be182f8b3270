"""Check a written table against its contract, and judge it by declared rules."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sedimenta.contracts import TableContract, quoted_column


def _out_of_period(contract: TableContract) -> Column | None:
    if not contract.event_time:
        return None
    year, month = contract.partition_by
    at = F.col(quoted_column(contract.event_time))
    return (F.year(at) != F.col(year)) | (F.month(at) != F.col(month))


def validate_table(df: DataFrame, contract: TableContract) -> DataFrame:
    """Per partition: rows, non-NULL values per column, rows whose time is in another month.

    A schema that does not fit the contract raises before anything is read. One pass; each
    task counts its own rows first, so the shuffle carries one row per partition and task.
    """
    contract.check(df.schema)
    counts = [F.count("*").alias("rows")] + [
        F.count(quoted_column(f.name)).alias(f"{f.name}_count") for f in contract.columns.fields
    ]
    elsewhere = _out_of_period(contract)
    if elsewhere is not None:
        counts.append(F.count_if(elsewhere).alias("rows_out_of_period"))
    return df.groupBy(*contract.partition_by).agg(*counts)


@dataclass(frozen=True)
class Rule:
    """At most a share of a partition's rows may meet the condition, an SQL expression."""

    name: str
    condition: str
    at_most: float = 0.0


def nulls(column: str, at_most: float = 0.0) -> Rule:
    return Rule(f"{column} is null", f"{quoted_column(column)} IS NULL", at_most)


@dataclass(frozen=True)
class Expectations:
    """What a load has to look like.

    rules          conditions on rows
    out_of_period  share of rows whose event time is in another month than their partition; None
                   for any
    least_rows     rows of a partition
    least_of_last  rows of a partition as a share of what it had before; None for any
    most_of_last   the same from above
    """

    rules: tuple[Rule, ...] = ()
    out_of_period: float | None = None
    least_rows: int = 0
    least_of_last: float | None = None
    most_of_last: float | None = None


VERDICT = ("rule", "measured", "low", "high", "passed")


def row_counts(df: DataFrame, contract: TableContract) -> DataFrame:
    """Rows of each partition, to compare the next load with."""
    return df.groupBy(*contract.partition_by).agg(F.count("*").alias("rows"))


def verdicts(
    df: DataFrame, contract: TableContract, expected: Expectations, last: DataFrame | None = None
) -> DataFrame:
    """One row per partition and rule: rule, measured, low and high limit, passed.

    Shares and row counts of all rules come from one pass over ``df``; ``last`` has the row counts of
    the load before (see :func:`row_counts`). A partition that was not there before passes the
    comparison with it; one that is missing now has no rows.
    """
    contract.check(df.schema)
    rules = list(expected.rules)
    elsewhere = _out_of_period(contract)
    conditions = {rule.name: (F.expr(rule.condition), rule.at_most) for rule in rules}
    if expected.out_of_period is not None:
        if elsewhere is None:
            raise ValueError(f"{contract.name} names no event time")
        conditions["out of period"] = (elsewhere, expected.out_of_period)
    counted = df.groupBy(*contract.partition_by).agg(
        F.count("*").alias("rows"),
        F.array(*[F.count_if(condition) for condition, _ in conditions.values()]).cast("array<bigint>").alias("hits"),
    )
    compared = last is not None and (expected.least_of_last, expected.most_of_last) != (None, None)
    if compared:
        before = last.select(*contract.partition_by, F.col("rows").alias("before"))
        counted = counted.join(before, list(contract.partition_by), "full")
    rows = F.coalesce(F.col("rows"), F.lit(0))
    hits = lambda i: F.coalesce(F.try_element_at("hits", F.lit(i + 1)), F.lit(0))

    def verdict(name: str, measured: Column, low: float | None, high: float | None) -> Column:
        limits = [F.lit(limit).cast("double") for limit in (low, high)]
        above = F.coalesce(measured >= limits[0], F.lit(True))
        below = F.coalesce(measured <= limits[1], F.lit(True))
        values = (F.lit(name), measured, *limits, above & below)
        return F.struct(*(v.alias(n) for v, n in zip(values, VERDICT, strict=True)))

    found = [
        verdict(name, F.coalesce(F.try_divide(hits(i).cast("double"), rows), F.lit(0.0)), None, at_most)
        for i, (name, (_, at_most)) in enumerate(conditions.items())
    ]
    found.append(verdict("rows", rows.cast("double"), expected.least_rows, None))
    if compared:
        share = F.try_divide(rows.cast("double"), F.col("before"))
        found.append(verdict("rows against last load", share, expected.least_of_last, expected.most_of_last))
    return counted.select(*contract.partition_by, F.explode(F.array(*found)).alias("v")).select(
        *contract.partition_by, "v.*"
    )


class ValidationError(RuntimeError):
    """A table does not look as expected."""


#: Failed verdicts that an error spells out.
_SHOWN = 20


def require_passed(found: DataFrame, name: str) -> None:
    """Raise if a verdict has failed, with the first of them."""
    failed = found.where("NOT passed")
    total = failed.count()
    if total:
        year, month = failed.columns[:2]
        lines = [
            f"{r[year]}-{r[month]:02d} {r['rule']}: {r['measured']:g} outside {r['low']}..{r['high']}"
            if r[month] is not None and r["measured"] is not None
            else f"{r[year]}-{r[month]} {r['rule']}: {r['measured']}"
            for r in failed.orderBy(year, month, "rule").limit(_SHOWN).collect()
        ]
        more = f" and {total - _SHOWN} more" if total > _SHOWN else ""
        raise ValidationError(f"{name}: {total} rules failed: {'; '.join(lines)}{more}")
