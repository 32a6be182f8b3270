from __future__ import annotations

import datetime as dt
import time
import uuid

import pyarrow as pa
import pyarrow.parquet as pq
import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.errors import AnalysisException
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sedimenta.contracts import TableContract
from sedimenta.functions.period import LEFTMOST_PERIOD, PeriodRange
from sedimenta.operators.conform import conform_all
from sedimenta.session import session_conf
from sedimenta.sources import landing
from sedimenta.sources.footers import NO_CLIENT, fingerprinted
from sedimenta.sources.landing import EmptyLanding, scan, schema_groups
from tests.conftest import plan_of, rows_of

CONTRACT = TableContract(
    "t",
    T.StructType(
        [T.StructField("VendorID", T.LongType()), T.StructField("RatecodeID", T.DoubleType())]
    ),
)


def longs(*values):
    return pa.array(values, pa.int64())


def doubles(*values):
    return pa.array(values, pa.float64())


def ints(*values):
    return pa.array(values, pa.int32())


def landed(spark, root, **options):
    return conform_all(scan(spark, root, CONTRACT, **options).groups, CONTRACT).rows


def test_recursive_case_sensitive_suffix(spark, drop):
    drop("a_2023-01.parquet", VendorID=longs(1))
    drop("deep/er/a_2023-02.parquet", VendorID=longs(2))
    drop("a_2023-03.PARQUET", VendorID=longs(3))
    root = drop("a_2023-04.parquet.bak", VendorID=longs(4))
    df = landed(spark, root).select("VendorID", "ano", "mes")
    assert rows_of(df) == [(1, 2023, 1), (2, 2023, 2)]


def test_agreeing_files_are_one_scan_without_matching_per_row(spark, drop):
    for month in range(1, 7):
        root = drop(f"a_2023-{month:02d}.parquet", VendorID=longs(month), RatecodeID=doubles(1.0))
    found = scan(spark, root, CONTRACT)
    assert len(found.groups) == 1
    plan = plan_of(found.groups[0])
    assert "regexp" not in plan and "Python" not in plan
    assert "Exchange" not in plan


def test_types_that_disagree_are_read_apart(spark, drop):
    drop("a_2023-01.parquet", VendorID=longs(1), RatecodeID=longs(7))
    drop("a_2023-02.parquet", VendorID=longs(2), RatecodeID=doubles(7.5), ehail_fee=pa.array(["x"]))
    drop("a_2023-03.parquet", VendorID=ints(3))
    drop("a_2023-04.parquet", VendorID=longs(4), RatecodeID=longs(8))
    root = drop("a_2023-05.parquet", VendorID=longs(5), RatecodeID=pa.array(["9.5"]))
    found = scan(spark, root, CONTRACT)
    assert len(found.groups) == 4
    df = conform_all(found.groups, CONTRACT).rows
    CONTRACT.check(df.schema)
    assert rows_of(df.select("VendorID", "RatecodeID", "ehail_fee", "ano", "mes")) == sorted(
        [
            (7.0, 1, 2023, None, 1),
            (7.5, 2, 2023, "x", 2),
            (None, 3, 2023, None, 3),
            (8.0, 4, 2023, None, 4),
            (9.5, 5, 2023, None, 5),
        ],
        key=repr,
    )


def test_disagreement_within_one_drop(spark, drop):
    drop("a_2023-01.parquet/part-0.parquet", VendorID=longs(1))
    drop("a_2023-01.parquet/part-1.parquet", VendorID=doubles(2.0))
    root = drop("a_2023-02.parquet/part-0.parquet", VendorID=longs(3))
    df = landed(spark, root).select("VendorID", "mes")
    assert rows_of(df) == [(1, 1), (2, 1), (3, 2)]


def test_number_of_probes_follows_number_of_changes(spark, drop, monkeypatch):
    for year in range(2020, 2024):
        for month in range(1, 13):
            kind = longs if (year, month) < (2022, 6) else doubles
            root = drop(f"a_{year}-{month:02d}.parquet", VendorID=kind(month))
    probes = []
    merged = landing._merged
    monkeypatch.setattr(landing, "_merged", lambda s, p: probes.append(p) or merged(s, p))
    paths = [f"{root}/a_{y}-{m:02d}.parquet" for y in range(2020, 2024) for m in range(1, 13)]
    groups = schema_groups(spark, paths)
    assert sorted(len(members) for _, members in groups) == [19, 29]
    assert len(probes) <= 15


_ARROW = {"int32": pa.int32(), "int64": pa.int64(), "double": pa.float64(), "text": pa.string()}


@settings(
    max_examples=12, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture]
)
@given(
    files=st.lists(
        st.dictionaries(
            st.sampled_from(["VendorID", "RatecodeID"]), st.sampled_from(sorted(_ARROW)), min_size=1
        ),
        min_size=1,
        max_size=9,
    )
)
def test_any_mix_of_files_gives_every_value_at_the_contract(spark, tmp_path_factory, files):
    folder = tmp_path_factory.mktemp("mix")
    expected = []
    for month, file in enumerate(files, 1):
        columns = {
            c: pa.array([str(month) if kind == "text" else month] * 2, _ARROW[kind])
            for c, kind in file.items()
        }
        pq.write_table(pa.table(columns), folder / f"a_2023-{month:02d}.parquet")
        row = (month if "RatecodeID" in file else None, month if "VendorID" in file else None)
        expected += [(*row, 2023, month)] * 2
    rows = landed(spark, str(folder))
    CONTRACT.check(rows.schema)
    found = rows.select("RatecodeID", "VendorID", "ano", "mes").collect()
    assert sorted(map(tuple, found), key=lambda r: r[3]) == expected


def test_files_of_two_writers_in_one_month(spark, drop, monkeypatch):
    writers = {"00ab12cd-1": longs, "77fe30aa-2": doubles}
    for part in range(40):
        for job, kind in writers.items():
            root = drop(f"a_2023-01.parquet/part-{part:05d}-{job}.parquet", VendorID=kind(part))
    probes = []
    merged = landing._merged
    monkeypatch.setattr(landing, "_merged", lambda s, p: probes.append(p) or merged(s, p))
    groups = schema_groups(spark, [f"{root}/a_2023-01.parquet"])
    assert sorted(len(members) for _, members in groups) == [40, 40]
    assert len(probes) <= 20
    assert landed(spark, root).agg(F.sum("VendorID")).first()[0] == 2 * sum(range(40))


def test_case_change_between_files(spark, drop):
    drop("a_2023-01.parquet", VendorID=longs(1), RATECODEID=doubles(1.5))
    root = drop("a_2023-02.parquet", vendorid=longs(2), RatecodeID=doubles(2.5))
    df = landed(spark, root).select("VendorID", "RatecodeID")
    assert rows_of(df) == [(1.5, 1), (2.5, 2)]


def test_files_without_period_are_kept_apart(spark, drop):
    drop("a_2023-01.parquet", VendorID=longs(1, 2))
    root = drop("a_undated.parquet", VendorID=longs(3, 4, 5))
    found = scan(spark, root, CONTRACT)
    (undated,) = found.without_period
    assert undated.count() == 3
    assert undated.inputFiles()[0].endswith("a_undated.parquet")
    assert found.summary.files_without_period == 1
    assert landed(spark, root).where("ano IS NULL OR mes IS NULL").count() == 0
    assert landed(spark, root).count() == 2


def test_range_of_months_reads_no_other_file(spark, drop):
    for month in range(1, 6):
        root = drop(f"a_2023-{month:02d}.parquet", VendorID=longs(month))
    found = scan(spark, root, CONTRACT, period=PeriodRange((2023, 2), (2023, 3)))
    assert found.summary.files == 2
    assert len(found.groups[0].inputFiles()) == 2
    with pytest.raises(EmptyLanding):
        scan(spark, root, CONTRACT, period=PeriodRange((2024, 1), (2024, 3)))


def test_names_of_different_form(spark, drop):
    drop("a_2023-01.parquet", VendorID=longs(1))
    root = drop("long_prefix_2023-02.parquet", VendorID=longs(2))
    assert len(scan(spark, root, CONTRACT).groups) == 1
    drop("b_2023-03_late.parquet", VendorID=longs(3))
    assert len(scan(spark, root, CONTRACT).groups) == 2
    assert rows_of(landed(spark, root).select("VendorID", "mes")) == [(1, 1), (2, 2), (3, 3)]


@pytest.mark.parametrize(
    "name",
    [
        lambda i: f"{'a' * (i + 1)}_2023-{i % 12 + 1:02d}.parquet",  # names that begin differently
        lambda i: f"2023-{i % 12 + 1:02d}_{'a' * (i + 1)}.parquet",  # names that end differently
        lambda i: f"{'f/' * i}x_2023-{i % 12 + 1:02d}_{'b' * (i % 3)}.parquet",  # folders of 200 depths
        lambda i: f"{'ç' * (i % 50 + 1)}/2023-{i % 12 + 1:02d}/{'b' * (i + 1)}.parquet",  # a dated folder
    ],
)
def test_any_depth_and_length_of_names_is_one_scan(spark, drop, name):
    count = 200
    for i in range(count):
        root = drop(name(i), VendorID=longs(i))
    found = scan(spark, root, CONTRACT)
    assert len(found.groups) == 1
    assert "regexp" not in plan_of(found.groups[0])
    df = conform_all(found.groups, CONTRACT).rows.select("VendorID", "mes")
    assert rows_of(df) == sorted(((i, i % 12 + 1) for i in range(count)), key=repr)


def jobs_of(spark, action) -> int:
    """Spark jobs that an action starts."""
    group = uuid.uuid4().hex
    spark.sparkContext.setJobGroup(group, group)
    action()
    jobs = spark.sparkContext.statusTracker().getJobIdsForGroup(group)
    spark.sparkContext.setJobGroup("", "")
    return len(jobs)


def alternating(drop, count: int, root: str) -> str:
    for i in range(count):
        kind = doubles if i % 2 else longs
        folder = drop(f"a_{2000 + i // 12}-{i % 12 + 1:02d}.parquet", root, VendorID=kind(i))
    return folder


def test_types_that_alternate_cost_a_constant_number_of_jobs(spark, drop, monkeypatch):
    small, large = alternating(drop, 8, "small"), alternating(drop, 64, "large")
    monkeypatch.setattr(landing, "schema_groups", None)
    found = []
    # Listing beyond 32 named files is a job for each scan.
    listing = {"spark.sql.sources.parallelPartitionDiscovery.threshold": "1000"}
    with session_conf(spark, listing):
        few = jobs_of(spark, lambda: scan(spark, small, CONTRACT))
        many = jobs_of(spark, lambda: found.append(scan(spark, large, CONTRACT)))
    # Adaptive execution may take one job more or less for a join.
    assert abs(many - few) <= 1 and many <= 24
    assert sorted(len(df.inputFiles()) for df in found[0].groups) == [32, 32]
    rows = conform_all(found[0].groups, CONTRACT).rows.select("VendorID", "ano", "mes")
    assert rows_of(rows) == sorted(((i, 2000 + i // 12, i % 12 + 1) for i in range(64)), key=repr)


def test_folders_of_one_schema_are_named_by_their_top(spark, drop, monkeypatch):
    for i in range(12):
        for part in range(3):
            kind = doubles if i % 2 else longs
            root = drop(f"k{i % 2}/deep/a_2023-{i + 1:02d}.parquet/part-{part}.parquet", VendorID=kind(i))
    drop("k2/a_2024-01.parquet", VendorID=longs(50))
    drop("k2/a_2024-02.parquet", VendorID=doubles(51))
    named = []
    reader_of = landing._reader_of
    monkeypatch.setattr(landing, "_reader_of", lambda s, schema, p, k: named.append(p) or reader_of(s, schema, p, k))
    assert landed(spark, root).count() == 38
    tops = sorted(path.partition("/landing/")[2] for paths in named for path in paths)
    assert tops == ["k0", "k1", "k2/a_2024-01.parquet", "k2/a_2024-02.parquet"]


def test_neighbours_of_a_root_with_a_pattern_are_not_read(spark, drop):
    drop("in1/a_2023-01.parquet", VendorID=longs(1))
    drop("in2/a_2023-02.parquet", VendorID=doubles(2))
    root = drop("out/a_2023-03.parquet", VendorID=doubles(3))
    found = conform_all(scan(spark, f"{root}/in*", CONTRACT).groups, CONTRACT).rows
    assert rows_of(found.select("VendorID", "mes")) == [(1, 1), (2, 2)]
    one = scan(spark, f"{root}/in2/a_2023-02.parquet", CONTRACT, period=PeriodRange((2023, 2), (2023, 2)))
    assert rows_of(conform_all(one.groups, CONTRACT).rows.select("VendorID", "mes")) == [(2, 2)]


def test_file_that_comes_after_the_listing_is_not_read(spark, drop):
    drop("a_2023-01.parquet", VendorID=longs(1))
    root = drop("a_2023-02.parquet", VendorID=doubles(2))
    drop("b/a_2023-03.parquet", VendorID=doubles(3))
    names = landing._Places._tops
    months = iter(range(4, 8))

    def late(*args):
        found = names(*args)
        time.sleep(0.01)
        drop(f"b/a_2023-{next(months):02d}.parquet", VendorID=longs(4))
        return found

    with pytest.MonkeyPatch.context() as patch:
        patch.setattr(landing._Places, "_tops", late)
        found = scan(spark, root, CONTRACT)
        ranged = scan(spark, f"{root}/b", CONTRACT, period=PeriodRange((2023, 1), (2023, 12)))
    assert rows_of(conform_all(found.groups, CONTRACT).rows.select("VendorID", "mes")) == [(1, 1), (2, 2), (3, 3)]
    assert rows_of(conform_all(ranged.groups, CONTRACT).rows.select("VendorID", "mes")) == [(3, 3), (4, 4)]


def test_store_without_a_client_in_the_tasks(spark, drop, monkeypatch):
    """Spark's own merging of footers takes over."""
    monkeypatch.setattr(landing, "fingerprinted", lambda files, tasks: files.selectExpr("*", "string(null) fingerprint", f"'{NO_CLIENT}' fault"))
    drop("a_2023-01.parquet", VendorID=longs(1))
    drop("a_2023-02.parquet", VendorID=doubles(2))
    root = drop("a_undated.parquet", VendorID=longs(3))
    found = scan(spark, root, CONTRACT)
    assert rows_of(conform_all(found.groups, CONTRACT).rows.select("VendorID", "mes")) == [(1, 1), (2, 2)]
    assert [df.count() for df in found.without_period] == [1]


def test_same_types_give_the_same_fingerprint(spark, drop, tmp_path):
    root = drop("a.parquet", VendorID=longs(1), RatecodeID=doubles(1))
    drop("b.parquet", VendorID=longs(2, 3), RatecodeID=doubles(None, 2))
    drop("c.parquet", VendorID=ints(2), RatecodeID=doubles(2))
    drop("d.parquet", RatecodeID=doubles(2), VendorID=longs(2))
    (tmp_path / "landing" / "e.parquet").write_bytes(b"no parquet file at all")
    paths = spark.createDataFrame([(f"file:{root}/{n}.parquet",) for n in "abcde"] + [("nowhere://x/y",)], "path string")
    found = [(r["fingerprint"], r["fault"]) for r in fingerprinted(paths, 2).orderBy("path").collect()]
    a, b, c, d, e, other = found
    assert a == b and len({a, c, d}) == 3 and a[1] is None
    assert e[0] is None and "Parquet" in e[1]
    assert other == (None, NO_CLIENT)


def test_odd_characters_in_paths(spark, drop):
    drop("a [x] {y} 10%_2023-01.parquet", VendorID=longs(1))
    drop("a [x] {y} 10%_2023-02.parquet", VendorID=doubles(2.0))
    root = drop("ação é_2023-03.parquet", VendorID=longs(3))
    assert rows_of(landed(spark, root).select("VendorID", "mes")) == [(1, 1), (2, 2), (3, 3)]


def test_loose_pattern_over_a_dated_folder(spark, drop):
    root = drop("1999-07/a.parquet", VendorID=longs(1))
    drop("1999-08/b.parquet", VendorID=longs(2))
    df = landed(spark, root, pattern=LEFTMOST_PERIOD).select("VendorID", "ano", "mes")
    assert rows_of(df) == [(1, 1999, 7), (2, 1999, 8)]


def test_pattern_over_two_folders(spark, drop):
    drop("y=2023/m=4/a.parquet", VendorID=longs(1))
    root = drop("y=2023/m=5/a.parquet", VendorID=doubles(2.0))
    df = landed(spark, root, pattern=r"y=(\d{4})/m=(\d+)").select("VendorID", "ano", "mes")
    assert rows_of(df) == [(1, 2023, 4), (2, 2023, 5)]


def test_source_columns_named_like_derived_ones_are_replaced(spark, drop):
    root = drop("a_2023-02.parquet", VendorID=longs(1), ANO=longs(1), mes=longs(1))
    assert rows_of(landed(spark, root).select("VendorID", "ano", "mes")) == [(1, 2023, 2)]


def test_times_keep_their_wall_clock_in_any_session_zone(spark, drop):
    night = dt.datetime(2024, 3, 10, 2, 30)
    root = drop("a_2024-03.parquet", at=pa.array([night], pa.timestamp("us")))
    contract = TableContract("t", T.StructType([T.StructField("at", T.TimestampNTZType())]))
    spark.conf.set("spark.sql.session.timeZone", "America/New_York")
    try:
        rows = conform_all(scan(spark, root, contract).groups, contract).rows
        assert rows.select(F.hour("at")).collect() == [(2,)]
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")


def test_nothing_to_read(spark, tmp_path):
    (tmp_path / "bare").mkdir()
    for root in ("bare", "missing"):
        for period in (None, PeriodRange((2023, 1), (2023, 2))):
            with pytest.raises(EmptyLanding):
                scan(spark, str(tmp_path / root), CONTRACT, period=period)


def test_drop_that_vanishes_is_a_failure_not_an_empty_landing(spark, drop):
    root = drop("a_2023-01.parquet", VendorID=longs(1))
    with pytest.raises(AnalysisException, match="PATH_NOT_FOUND"):
        schema_groups(spark, [f"{root}/a_2023-01.parquet", f"{root}/a_2023-02.parquet"])


def test_unreadable_file_raises(spark, drop, tmp_path):
    root = drop("a_2023-01.parquet", VendorID=longs(1))
    (tmp_path / "landing" / "a_2023-02.parquet").write_bytes(b"no parquet file at all")
    with pytest.raises(Exception, match="CANNOT_READ_FILE_FOOTER"):
        scan(spark, root, CONTRACT)


def test_dated_folders(spark, drop):
    drop("2023-01/part-0.parquet", VendorID=longs(1))
    drop("2023-02/part-0.parquet", VendorID=longs(2))
    root = drop("2023-02/part-00001-5e0f2a10-1234-11bc-8d3a-0123456789ab.parquet", VendorID=longs(3))
    assert rows_of(landed(spark, root).select("VendorID", "mes")) == [(1, 1), (2, 2), (3, 2)]
