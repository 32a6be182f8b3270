from __future__ import annotations

import re

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from sedimenta.functions.period import (
    LEFTMOST_PERIOD,
    PERIOD_IN_PATH,
    PeriodRange,
    PeriodSlice,
    period_by_slice,
    period_of,
    slice_of,
)


def periods(spark, paths, pattern=PERIOD_IN_PATH):
    year, month = period_of(F.col("p"), pattern)
    df = spark.createDataFrame([(p,) for p in paths], "p string").select(year, month)
    return [tuple(r) for r in df.collect()]


@pytest.mark.parametrize(
    ("path", "expected"),
    [
        ("file:/l/yellow/yellow_2023-05.parquet", (2023, 5)),
        ("file:/2099-11/landing/x_1996-01.parquet/part-00000-8512-12.c000.parquet", (1996, 1)),
        ("file:/l/part-00000-8512-12ab-9d00-c000.parquet", (None, None)),
        ("file:/l/x_1899-12.parquet", (1899, 12)),
        ("file:/l/x_2101-01.parquet", (2101, 1)),
        ("file:/l/2023-01/part-0.parquet", (2023, 1)),
        ("file:/l/2023-01/day=1/part-00000-1234-11bc-9d00.parquet", (2023, 1)),
        ("file:/l/2020-01/2023-02/part-0.parquet", (2020, 1)),
        ("file:/l/2020-01/y_2023-02.parquet", (2023, 2)),
        ("file:/l/x_2023-13.parquet", (None, None)),
        ("file:/l/x_12023-011.parquet", (None, None)),
        ("file:/l/no_period.parquet", (None, None)),
        ("file:/l/x_2023-05_v2.parquet", (2023, 5)),
    ],
)
def test_default_pattern(spark, path, expected):
    assert periods(spark, [path]) == [expected]


def test_loose_pattern_takes_the_leftmost_match(spark):
    assert periods(spark, ["file:/2099-11/l/x_1996-01.parquet"], LEFTMOST_PERIOD) == [(2099, 11)]


def test_range_of_months(spark):
    wanted = PeriodRange((2022, 11), (2023, 2))
    months = spark.range(2021 * 12, 2025 * 12).selectExpr(
        "int(id / 12) AS ano", "int(id % 12) + 1 AS mes"
    )
    held = months.where(wanted.holds(F.col("ano"), F.col("mes"))).collect()
    assert sorted(map(tuple, held)) == [(2022, 11), (2022, 12), (2023, 1), (2023, 2)]


@pytest.mark.parametrize("bounds", [((2023, 5), (2023, 4)), ((2023, 0), (2023, 4)), ((1, 1), (1, 13))])
def test_no_range_of_months(bounds):
    with pytest.raises(ValueError, match="no range"):
        PeriodRange(*bounds)


_NAME = st.text(st.sampled_from("ab01_ é-"), max_size=8)


@settings(
    max_examples=25, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture]
)
@given(
    paths=st.lists(
        st.tuples(_NAME, st.integers(1990, 2035), st.integers(1, 12), _NAME).map(
            lambda t: f"file:/l{t[0]}/x_{t[1]}-{t[2]:02d}{t[3]}.parquet"
        ),
        min_size=1,
        max_size=20,
    ),
    pattern=st.sampled_from([PERIOD_IN_PATH, LEFTMOST_PERIOD, r"_(\d\d\d\d)-(\d\d)"]),
)
def test_slicing_equals_matching(spark, paths, pattern):
    path = F.col("p")
    df = spark.createDataFrame([(p,) for p in paths], "p string")
    year, month = period_of(path, pattern)
    listed = df.select("p", year.alias("y"), month.alias("m"), slice_of(path, pattern).alias("at"))
    for row in listed.where("y IS NOT NULL AND m IS NOT NULL").collect():
        cut = period_by_slice(F.lit(row["p"]), PeriodSlice(**row["at"].asDict()))
        assert tuple(spark.range(1).select(*cut).first()) == (row["y"], row["m"])
        found = re.search(pattern, row["p"])
        assert (int(found[1]), int(found[2])) == (row["y"], row["m"])


def test_one_file_name_form_gives_one_slice(spark):
    paths = [(f"file:/l/x_{y}-{m:02d}.parquet",) for y in range(1999, 2024) for m in range(1, 13)]
    df = spark.createDataFrame(paths, "p string")
    assert df.select(slice_of(F.col("p"))).distinct().count() == 1
