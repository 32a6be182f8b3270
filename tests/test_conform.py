from __future__ import annotations

import datetime as dt
import itertools
import math

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sedimenta.contracts import ContractError, TableContract
from sedimenta.functions.casts import castable, common_type, may_lose
from sedimenta.operators.conform import conform, conform_all
from tests.conftest import plan_of, rows_of

LONG, DOUBLE, INT, STRING = T.LongType(), T.DoubleType(), T.IntegerType(), T.StringType()
NTZ = T.TimestampNTZType()


def struct(**columns: T.DataType) -> T.StructType:
    return T.StructType([T.StructField(n, t) for n, t in columns.items()])


def test_declared_order_missing_and_extra_columns(spark):
    df = spark.createDataFrame([(1, "x", 2.0)], "extra int, b string, A double")
    declared = struct(a=LONG, missing=DOUBLE, b=STRING)
    kept = conform(df, declared, "keep")
    assert kept.columns == ["a", "missing", "b", "extra"]
    assert [f.dataType for f in kept.schema.fields] == [LONG, DOUBLE, STRING, INT]
    assert kept.collect() == [(2, None, "x", 1)]
    assert conform(df, declared, "drop").columns == ["a", "missing", "b"]


def test_case_change_keeps_values(spark):
    df = spark.createDataFrame([(1.5,)], "Airport_fee double")
    assert conform(df, struct(airport_fee=DOUBLE)).collect() == [(1.5,)]


def test_column_named_with_a_dot(spark):
    df = spark.createDataFrame([(1, 2)], "`a.b` int, `c d` int")
    assert conform(df, struct(**{"a.b": LONG})).collect() == [(1, 2)]


def test_names_that_differ_in_case_only_are_refused(spark):
    df = spark.createDataFrame([(1, 2)], "a int, A int")
    with pytest.raises(ContractError, match="letter case"):
        conform(df, struct(a=LONG))


@pytest.mark.parametrize(
    ("ddl", "value", "target", "expected"),
    [
        ("string", "abc", DOUBLE, None),
        ("string", "1.25", DOUBLE, 1.25),
        ("double", 1e12, INT, None),
        ("double", math.nan, INT, None),
        ("double", 1.9, INT, 1),
        ("double", -1.9, INT, -1),
        ("bigint", 2**40, INT, None),
        ("bigint", 7, DOUBLE, 7.0),
        ("double", 1.5, STRING, "1.5"),
        ("string", "2024-03-10 02:30:00", NTZ, dt.datetime(2024, 3, 10, 2, 30)),
        ("string", "yesterday", NTZ, None),
    ],
)
def test_casts_never_raise_and_lost_values_are_flagged(spark, ddl, value, target, expected):
    df = spark.createDataFrame([(value, 2023, 1)], f"v {ddl}, ano int, mes int")
    contract = TableContract("t", struct(v=target))
    conformed = conform_all([df], contract)
    assert conformed.rows.select("v").collect() == [(expected,)]
    lost = conformed.rows.agg(F.lit(0).alias("none"), *conformed.lost_counts()).first().asDict()
    assert lost.get("v", 0) == (expected is None)


_VALUES = {
    "tinyint": [-128, 0, 127],
    "int": [-(2**31), 0, 2**31 - 1],
    "bigint": [-(2**63), 0, 2**63 - 1],
    "float": [math.nan, math.inf, 1e30, 0.5],
    "double": [math.nan, math.inf, 1e300, 0.5],
    "string": ["x", "", "12", "1e400"],
    "boolean": [True, False],
    "timestamp_ntz": [dt.datetime(1, 1, 1), dt.datetime(2024, 1, 1)],
    "date": [dt.date(1, 1, 1), dt.date(2024, 1, 1)],
}


@pytest.mark.parametrize("ddl", list(_VALUES))
@pytest.mark.parametrize("target", [LONG, DOUBLE, INT, STRING, NTZ])
def test_casts_called_safe_lose_nothing(spark, ddl, target):
    df = spark.createDataFrame([(v,) for v in _VALUES[ddl]], f"v {ddl}")
    source = df.schema["v"].dataType
    if may_lose(source, target):
        return
    assert conform(df, struct(v=target)).where("v IS NULL").count() == 0


def test_groups_go_together_and_conflicting_extras_are_refused(spark):
    contract = TableContract("t", struct(v=DOUBLE))
    first = spark.createDataFrame([(1, "x", 2023, 1)], "v bigint, note string, ano int, mes int")
    second = spark.createDataFrame([(2.5, 2023, 2)], "V double, ano int, mes int")
    rows = conform_all([first, second], contract).rows
    assert rows_of(rows.select("v", "note", "ano", "mes")) == [
        (2023, 1, "x", 1.0),
        (2023, 2, None, 2.5),
    ]
    third = spark.createDataFrame([(2.5, 7, 2023, 2)], "v double, NOTE int, ano int, mes int")
    both = conform_all([first, third], contract).rows
    assert rows_of(both.select("v", "note")) == [("7", 2.5), ("x", 1.0)]
    assert conform_all([first, third], contract, "drop").rows.columns == ["v", "ano", "mes"]


_LITERALS = {
    "tinyint": "7Y", "smallint": "-300S", "int": "70000", "bigint": "4294967296L", "float": "float(0.5)",
    "double": "0.1D", "decimal(9,2)": "-7.25BD", "string": "'text'", "boolean": "true",
    "date": "date'2024-02-29'", "timestamp_ntz": "timestamp_ntz'2024-02-29 12:00:00.5'",
    "timestamp": "timestamp'2024-02-29 12:00:00.5'", "void": "NULL", "array<int>": "array(1, 2)",
    "struct<a:int>": "named_struct('a', 1)",
}


@pytest.mark.parametrize("one", list(_LITERALS))
@pytest.mark.parametrize("other", list(_LITERALS))
def test_undeclared_columns_of_any_two_types_keep_their_values(spark, one, other):
    contract = TableContract("t", struct(v=DOUBLE))
    parts = [spark.range(1).selectExpr(f"{_LITERALS[t]} AS x", "2023 AS ano", "1 AS mes") for t in (one, other)]
    rows = conform_all(parts, contract).rows
    kind = rows.schema["x"].dataType
    assert kind == common_type(parts[0].schema["x"].dataType, parts[1].schema["x"].dataType)
    assert kind == common_type(parts[1].schema["x"].dataType, parts[0].schema["x"].dataType)
    found = [r["x"] for r in rows.collect()]
    for value, t in zip(found, (one, other), strict=True):
        own = spark.sql(f"SELECT {_LITERALS[t]}").first()[0]
        if t == "void":
            assert value is None
        elif kind.simpleString() != "string":
            back = spark.createDataFrame([(value,)], f"x {kind.simpleString()}").selectExpr(f"CAST(x AS {t})")
            assert back.first()[0] == own
        else:
            assert isinstance(value, str) and value


def test_three_types_meet_in_the_same_one_in_any_order(spark):
    kinds = [T._parse_datatype_string(t) for t in _LITERALS if t != "void"]
    for a, b, c in itertools.permutations(kinds, 3):
        assert common_type(common_type(a, b), c) == common_type(a, common_type(b, c))


def test_nested_source_for_a_plain_column_is_refused(spark):
    df = spark.createDataFrame([([1.5],)], "v array<double>")
    with pytest.raises(ContractError, match="v comes as array<double>, declared double"):
        conform(df, struct(v=DOUBLE))
    assert conform(df, struct(v=STRING)).collect() == [("[1.5]",)]


def test_conform_is_one_projection(spark):
    df = spark.range(5).selectExpr("id AS a", "CAST(id AS STRING) AS b")
    plan = plan_of(conform(df, struct(a=DOUBLE, b=LONG, c=STRING)))
    assert plan.count("Project") == 1
    assert "Python" not in plan


@settings(
    max_examples=25, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture]
)
@given(
    files=st.lists(
        st.dictionaries(
            st.sampled_from(["VendorID", "vendorid", "RatecodeID", "airport_fee", "new_column"]),
            st.sampled_from(["bigint", "double", "int", "string"]),
            min_size=1,
        ).filter(lambda f: not {"VendorID", "vendorid"} <= set(f)),
        min_size=1,
        max_size=4,
    )
)
def test_any_drift_ends_at_the_contract(spark, files):
    contract = TableContract("t", struct(VendorID=LONG, RatecodeID=DOUBLE, airport_fee=DOUBLE))
    groups = [
        spark.range(2).selectExpr(
            *(f"CAST(id AS {kind}) AS `{column}`" for column, kind in file.items()),
            "2023 AS ano",
            f"{month} AS mes",
        )
        for month, file in enumerate(files, 1)
    ]
    rows = conform_all(groups, contract, "drop").rows
    contract.check(rows.schema)
    assert rows.count() == 2 * len(files)


@pytest.mark.parametrize("target", ["string", "boolean", "int", "bigint", "double", "decimal(10,2)", "date", "timestamp", "timestamp_ntz", "binary"])
@pytest.mark.parametrize("source", ["string", "boolean", "int", "bigint", "double", "decimal(10,2)", "date", "timestamp", "timestamp_ntz"])
def test_every_pair_of_types_converts_or_is_refused(spark, source, target):
    have, want = (spark.sql(f"SELECT CAST(NULL AS {t}) AS x").schema["x"].dataType for t in (source, target))
    value = {"string": "'x'", "boolean": "true", "date": "'2020-01-01'", "timestamp": "'2020-01-01'", "timestamp_ntz": "'2020-01-01'"}.get(source, "7")
    df = spark.sql(f"SELECT CAST({value} AS {source}) AS x")
    declared = T.StructType([T.StructField("x", want)])
    if castable(have, want):
        assert conform(df, declared).schema["x"].dataType == want
        conform(df, declared).collect()
    else:
        with pytest.raises(ContractError, match="declared"):
            conform(df, declared)


def test_numbers_become_times_after_1970(spark):
    df = spark.sql("SELECT * FROM VALUES (0L), (86400L), (9223372036854775807L), (NULL) AS t(x)")
    declared = T.StructType([T.StructField("x", T.TimestampNTZType())])
    got = [r["x"] for r in conform(df, declared).collect()]
    assert got == [dt.datetime(1970, 1, 1), dt.datetime(1970, 1, 2), None, None]
