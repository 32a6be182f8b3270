"""Grouped means over the unified table.

Spark averages within each task before the shuffle, so what moves is one row per group and
task, however many rows a group has.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def mean_by_period(
    df: DataFrame,
    value: str = "valor_total",
    kind: str | None = "yellow",
    kind_column: str = "tipo_taxi",
    period: tuple[str, str] = ("ano", "mes"),
    name: str = "media_valor_total",
) -> DataFrame:
    """Mean of ``value`` per year and month, of one kind or of all (``kind=None``)."""
    if kind is not None:
        df = df.where(F.col(kind_column) == kind)
    return df.groupBy(*period).agg(F.avg(value).alias(name))


def mean_by_hour(
    df: DataFrame,
    value: str = "quantidade_passageiros",
    time: str = "data_inicio_viagem",
    month: int | None = 5,
    year: int | None = None,
    period: tuple[str, str] = ("ano", "mes"),
    hour_name: str = "hora_do_dia",
    name: str = "media_passageiros",
) -> DataFrame:
    """Mean of ``value`` per hour of day.

    ``month`` and ``year`` select partitions. A month without a year takes that month of
    every year; neither takes every row.
    """
    wanted: list[Column] = [
        F.col(column) == number
        for column, number in zip(period, (year, month))
        if number is not None
    ]
    for condition in wanted:
        df = df.where(condition)
    return df.groupBy(F.hour(time).alias(hour_name)).agg(F.avg(value).alias(name))


def mean_states(
    df: DataFrame, value: str, keys: Sequence[Column], period: tuple[str, str] = ("ano", "mes")
) -> DataFrame:
    """What a mean of any months is put together from: ``total`` and ``n`` per month and key.

    ``keys`` are all columns that a result groups or filters by, so that a month's states are
    those of all its rows.
    """
    return df.groupBy(*keys, *period).agg(F.sum(value).alias("total"), F.count(value).alias("n"))


def merged_mean(states: DataFrame, keys: Sequence[str], name: str) -> DataFrame:
    """Mean per key from the states of all months; NULL where no row had a value."""
    mean = F.try_divide(F.sum("total").cast("double"), F.sum("n"))
    return states.groupBy(*keys).agg(mean.alias(name))
