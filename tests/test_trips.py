"""The taxi pipeline on small hand-made files, against plain Python arithmetic."""

from __future__ import annotations

import csv
import datetime as dt
import random
from collections import defaultdict
from dataclasses import replace
from statistics import fmean

import pyarrow as pa
import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from jobs import trips as job
from sedimenta.functions.period import MonthSet, PeriodRange
from sedimenta.operators.means import mean_by_hour, mean_by_period
from sedimenta.operators.unify import SourceMapping, map_source, unify
from sedimenta.operators.validate import ValidationError
from sedimenta.plans import trips
from sedimenta.plans.bronze import Dataset, report_frame, run_bronze
from sedimenta.plans import pipeline as pipeline_module
from sedimenta.plans.pipeline import Pipeline, open_loads, run_pipeline
from sedimenta.plans.silver import PipelineError, SilverLayer, run_silver, unified
from sedimenta.plans.trips import trips_pipeline
from sedimenta.sources.rejects import rejected
from tests.conftest import plan_of, rows_of

YELLOW_FILES = {  # month of the file: type of passenger_count
    (2022, 5): pa.int64(),
    (2023, 1): pa.float64(),
    (2023, 5): pa.int32(),
}
GREEN_FILES = {(2023, 1): pa.float64(), (2023, 5): pa.int64()}


def make_trips(root, kind, prefix, files, seed):
    """Write one file per month; returns (year, month, start, passengers, total) per row."""
    rng = random.Random(seed)
    made = []
    for (year, month), passenger_type in files.items():
        rows = []
        for i in range(200):
            at = dt.datetime(year, month, 1, rng.randrange(24), 0) + dt.timedelta(days=i % 28)
            if i == 0:
                at = dt.datetime(2009, 1, 1, 3)  # a clock that was off: stays in the file's month
            passengers = rng.choice([None, 0, 1, 2, 3])
            rows.append((year, month, at, passengers, rng.randrange(300, 9000) / 100))
        made += rows
        columns = {
            "VendorID": pa.array(
                [1 + i % 2 for i in range(200)], pa.int64() if year == 2022 else pa.int32()
            ),
            f"{prefix}_pickup_datetime": pa.array([r[2] for r in rows], pa.timestamp("us")),
            f"{prefix}_dropoff_datetime": pa.array(
                [r[2] + dt.timedelta(minutes=9) for r in rows], pa.timestamp("us")
            ),
            "passenger_count": pa.array([r[3] for r in rows], passenger_type),
            "RatecodeID": pa.array(
                [1] * 200, pa.float64() if passenger_type == pa.float64() else pa.int64()
            ),
            "total_amount": pa.array([r[4] for r in rows], pa.float64()),
        }
        if kind == "yellow":
            fee = "airport_fee" if month == 1 else "Airport_fee"
            columns[fee] = pa.array([1.25] * 200, pa.float64())
        else:  # a column that is empty throughout has no type of its own
            columns["ehail_fee"] = pa.nulls(200) if month == 1 else pa.array([0.5] * 200)
        folder = root / "landing" / kind
        folder.mkdir(parents=True, exist_ok=True)
        pq.write_table(
            pa.table(columns), folder / f"{kind}_tripdata_{year}-{month:02d}.parquet"
        )
    return made


@pytest.fixture
def lake(spark, tmp_path, monkeypatch):
    for database in ("bronze", "silver", "gold"):
        spark.sql(f"DROP DATABASE IF EXISTS dados_taxi_{database} CASCADE")
    yellow = make_trips(tmp_path, "yellow", "tpep", YELLOW_FILES, 1)
    green = make_trips(tmp_path, "green", "lpep", GREEN_FILES, 2)
    roots = {n: str(tmp_path / n) for n in ("landing", "bronze", "silver", "gold")}
    return trips_pipeline(**roots), yellow, green, roots


def expected_monthly(yellow):
    groups = defaultdict(list)
    for year, month, _, _, total in yellow:
        groups[year, month].append(total)
    return {k: fmean(v) for k, v in groups.items()}


def expected_hourly(rows, month):
    groups = defaultdict(list)
    for _, file_month, at, passengers, _ in rows:
        if month in (None, file_month) and passengers is not None:
            groups[at.hour].append(passengers)
    return {k: fmean(v) for k, v in groups.items()}


def check_gold(gold, yellow, green):
    monthly = gold[trips.MONTHLY_MEAN_TABLE]
    assert monthly.dtypes == [("ano", "int"), ("mes", "int"), ("media_valor_total", "double")]
    assert {(r[0], r[1]): r[2] for r in monthly.collect()} == pytest.approx(
        expected_monthly(yellow)
    )
    hourly = gold[trips.HOURLY_MEAN_TABLE]
    assert hourly.dtypes == [("hora_do_dia", "int"), ("media_passageiros", "double")]
    assert dict(map(tuple, hourly.collect())) == pytest.approx(
        expected_hourly(yellow + green, 5)
    )


def test_all_layers_and_rerun(spark, lake):
    pipeline, yellow, green, _ = lake
    for _ in range(2):
        run = run_pipeline(spark, pipeline)
        assert [(r.status, r.rows_written, r.values_lost) for r in run.reports] == [
            ("ok", 600, {}),
            ("ok", 400, {}),
        ]
        for contract in (trips.YELLOW, trips.GREEN, trips.TRIPS):
            contract.check(spark.table(contract.name).schema)
        assert spark.table(trips.TRIPS_TABLE).count() == 1000
        check_gold(run.gold, yellow, green)
    bronze = spark.table(trips.YELLOW_TABLE)
    assert bronze.where("airport_fee = 1.25 AND ingestion_ts IS NOT NULL").count() == 600
    assert bronze.select("ingestion_ts").distinct().count() == 1
    green = spark.table(trips.GREEN_TABLE).groupBy("mes", "ehail_fee").count()
    assert rows_of(green) == [(200, "0.5", 5), (200, None, 1)]


def test_append_doubles_bronze(spark, lake):
    pipeline, yellow, green, _ = lake
    run_bronze(spark, pipeline.bronze, "append")
    run = run_pipeline(spark, pipeline, bronze_mode="append")
    assert spark.table(trips.TRIPS_TABLE).count() == 2000
    check_gold(run.gold, yellow, green)


def test_one_month_at_a_time(spark, lake):
    pipeline, yellow, green, _ = lake
    for first, last in (((2022, 5), (2023, 1)), ((2023, 5), (2023, 5)), ((2023, 5), (2023, 5))):
        run = run_pipeline(
            spark, pipeline, silver_mode="replace_partitions", period=PeriodRange(first, last)
        )
    assert spark.table(trips.TRIPS_TABLE).count() == 1000
    check_gold(run.gold, yellow, green)


def test_ad_hoc_sql_on_the_tables(spark, lake):
    pipeline, yellow, green, _ = lake
    run_pipeline(spark, pipeline)
    df = spark.sql(
        f"SELECT HOUR(data_inicio_viagem) AS hora_do_dia, "
        f"AVG(quantidade_passageiros) AS media_passageiros FROM {trips.TRIPS_TABLE} "
        "WHERE mes = 5 GROUP BY HOUR(data_inicio_viagem) ORDER BY hora_do_dia"
    )
    assert dict(map(tuple, df.collect())) == pytest.approx(expected_hourly(yellow + green, 5))
    every = mean_by_hour(spark.table(trips.TRIPS_TABLE), month=None)
    assert dict(map(tuple, every.collect())) == pytest.approx(
        expected_hourly(yellow + green, None)
    )


def test_job_script_with_csv(spark, lake, tmp_path):
    _, yellow, green, roots = lake
    arguments = [x for n, path in roots.items() for x in (f"--{n}", path)]
    job.main([*arguments, "--csv", str(tmp_path / "csv")])
    (file,) = (tmp_path / "csv" / "media_valor_total_mes_yellow").glob("*.csv")
    with file.open() as lines:
        table = [(int(r["ano"]), int(r["mes"]), float(r["media_valor_total"])) for r in csv.DictReader(lines)]
    assert table == sorted(table)
    assert {t[:2]: t[2] for t in table} == pytest.approx(expected_monthly(yellow))
    job.main([*arguments, "--steps", "gold", "--gold-mode", "once"])
    check_gold({t: spark.table(t) for t in (trips.MONTHLY_MEAN_TABLE, trips.HOURLY_MEAN_TABLE)}, yellow, green)


def test_job_script_over_changed_files_only(spark, lake, tmp_path):
    _, yellow, green, roots = lake
    arguments = [x for n, path in roots.items() for x in (f"--{n}", path)]
    arguments += ["--manifest", str(tmp_path / "manifest"), "--changed-only", "--publish-checked"]
    job.main([*arguments, "--least-rows", "100"])
    check_gold({t: spark.table(t) for t in (trips.MONTHLY_MEAN_TABLE, trips.HOURLY_MEAN_TABLE)}, yellow, green)
    more = make_trips(tmp_path, "yellow", "tpep", {(2023, 1): pa.float64(), (2023, 6): pa.int64()}, 7)
    yellow = [r for r in yellow if r[:2] != (2023, 1)] + more
    for _ in range(2):  # the second time there is nothing to load
        job.main(arguments)
        check_gold({t: spark.table(t) for t in (trips.MONTHLY_MEAN_TABLE, trips.HOURLY_MEAN_TABLE)}, yellow, green)
    assert spark.table(trips.TRIPS_TABLE).count() == len(yellow) + len(green)


def test_run_that_was_cut_off_behind_bronze_is_caught_up(spark, lake, tmp_path, monkeypatch):
    _, yellow, green, roots = lake
    pipeline = trips_pipeline(**roots, manifest=str(tmp_path / "manifest"))
    check_gold(run_pipeline(spark, pipeline, changed_only=True).gold, yellow, green)
    more = make_trips(tmp_path, "yellow", "tpep", {(2023, 1): pa.float64()}, 7)
    yellow = [r for r in yellow if r[:2] != (2023, 1)] + more

    def fails(*args, **kwargs):
        raise OSError("lost")

    for step in ("run_silver", "run_gold"):
        with monkeypatch.context() as patch:
            patch.setattr(pipeline_module, step, fails)
            with pytest.raises(OSError, match="lost"):
                run_pipeline(spark, pipeline, changed_only=True)
    run = run_pipeline(spark, pipeline, changed_only=True)
    assert [r.status for r in run.reports] == ["unchanged", "unchanged"]
    check_gold(run.gold, yellow, green)
    assert open_loads(spark, pipeline) == ([], MonthSet(frozenset()))


def test_job_script_fails_where_a_rule_does(spark, lake):
    _, _, _, roots = lake
    arguments = [x for n, path in roots.items() for x in (f"--{n}", path)]
    with pytest.raises(ValidationError, match="taxi_yellow: 3 rules failed.*corridas_taxi: 3 rules failed"):
        job.main([*arguments, "--out-of-period", "0"])  # a clock was off in each file
    job.main([*arguments, "--steps", "validate", "--out-of-period", "0.01", "--least-rows", "200"])
    with pytest.raises(ValidationError, match="2022-05 rows: 200 outside 201"):
        job.main([*arguments, "--steps", "validate", "--least-rows", "201"])


def test_empty_landing_stops_later_layers_unless_allowed(spark, lake, tmp_path):
    pipeline, *_ = lake
    run_pipeline(spark, pipeline)
    mistyped = replace(pipeline.bronze[0], landing=str(tmp_path / "landing" / "yelow"))
    wrong = replace(pipeline, bronze=(mistyped, pipeline.bronze[1]))
    with pytest.raises(PipelineError, match="taxi_yellow: no Parquet file"):
        run_pipeline(spark, wrong)
    assert run_pipeline(spark, wrong, allow_empty=True).reports[0].status == "empty"


def test_no_folder_may_be_another_layers(lake, tmp_path):
    pipeline, *_ = lake
    for option in ("rejects", "manifest"):
        first = replace(pipeline.bronze[0], **{option: pipeline.silver.location})
        with pytest.raises(ValueError, match="overlap"):
            replace(pipeline, bronze=(first, pipeline.bronze[1]))


def test_failed_dataset_stops_later_layers_but_not_its_sibling(spark, lake, tmp_path):
    pipeline, *_ = lake
    run_pipeline(spark, pipeline)
    (tmp_path / "landing/yellow/yellow_tripdata_2023-06.parquet").write_bytes(b"junk" * 10)
    with pytest.raises(PipelineError, match="taxi_yellow"):
        run_pipeline(spark, pipeline)
    reports = run_bronze(spark, pipeline.bronze)
    assert [r.status for r in reports] == ["failed", "ok"]
    assert "yellow_tripdata_2023-06.parquet" in reports[0].message
    assert spark.table(trips.TRIPS_TABLE).count() == 1000


def test_silver_is_not_replaced_while_a_source_is_missing(spark, lake):
    pipeline, *_ = lake
    run_pipeline(spark, pipeline)
    spark.sql(f"DROP TABLE {trips.GREEN_TABLE}")
    with pytest.raises(PipelineError, match="taxi_green"):
        run_silver(spark, pipeline.silver)
    assert spark.table(trips.TRIPS_TABLE).count() == 1000


def test_report_of_every_outcome(spark, lake, tmp_path):
    pipeline, *_ = lake
    yellow = pipeline.bronze[0]
    dirty = tmp_path / "dirty"
    dirty.mkdir()
    columns = {
        "VendorID": pa.array(["1", "x", None]),
        "passenger_count": pa.array([1.0, float("nan"), 1e30]),
    }
    pq.write_table(pa.table(columns), dirty / "y_2023-01.parquet")
    pq.write_table(pa.table(columns), dirty / "undated.parquet")
    (tmp_path / "corrupt").mkdir()
    (tmp_path / "corrupt" / "y_2023-01.parquet").write_bytes(b"junk" * 10)
    only_undated = tmp_path / "only_undated"
    only_undated.mkdir()
    pq.write_table(pa.table(columns), only_undated / "a.parquet")
    name = trips.YELLOW_TABLE

    def named(label):
        return replace(yellow.contract, name=f"{name}_{label}")

    reports = run_bronze(
        spark,
        [yellow]
        + [
            Dataset(named(n), str(tmp_path / n), str(tmp_path / "out" / n))
            for n in ("nothing", "dirty", "corrupt", "only_undated")
        ],
    )
    lines = report_frame(spark, reports).drop("message", "load").collect()
    assert [tuple(r) for r in lines] == [
        (name, "ok", False, False, 600, 600, 0, {}),
        (f"{name}_nothing", "empty", False, False, 0, 0, 0, {}),
        (f"{name}_dirty", "rejected", True, True, 6, 3, 3, {"VendorID": 1, "passenger_count": 2}),
        (f"{name}_corrupt", "failed", False, False, 0, 0, 0, {}),
        (f"{name}_only_undated", "rejected", True, False, 3, 0, 3, {}),
    ]
    kept = rejected(spark, str(tmp_path / "out" / "dirty_rejects"))
    assert kept.count() == 3 and kept.where("source_path LIKE '%undated.parquet'").count() == 3
    assert kept.where("row.passenger_count = 1 AND row.VendorID = '1'").count() == 1


@pytest.mark.parametrize("fault", ["rejected", "lossy"])
def test_missing_rows_and_values_stop_later_layers_unless_allowed(spark, lake, tmp_path, fault):
    pipeline, *_ = lake
    run_pipeline(spark, pipeline)
    vendor = pa.array(["1", "x"] if fault == "lossy" else [1, 2])
    file = "late_2023-06.parquet" if fault == "lossy" else "late.parquet"
    pq.write_table(pa.table({"VendorID": vendor}), tmp_path / "landing" / "yellow" / file)
    with pytest.raises(PipelineError, match="taxi_yellow"):
        run_pipeline(spark, pipeline)
    assert spark.table(trips.TRIPS_TABLE).count() == 1000
    run = run_pipeline(spark, pipeline, **{f"allow_{fault}": True})
    assert run.reports[0].status == fault
    assert spark.table(trips.TRIPS_TABLE).count() == (1002 if fault == "lossy" else 1000)


def test_second_location_is_refused_before_anything_is_written(spark, lake, tmp_path):
    yellow = lake[0].bronze[0]
    run_bronze(spark, [yellow])
    (report,) = run_bronze(spark, [replace(yellow, location=str(tmp_path / "elsewhere"))])
    assert report.status == "failed" and "is at" in report.message
    assert not (tmp_path / "elsewhere").exists()


def test_range_with_replace_all_is_refused_for_bronze(spark, lake):
    yellow = lake[0].bronze[0]
    run_bronze(spark, [yellow])
    (report,) = run_bronze(spark, [yellow], "replace_all", PeriodRange((2023, 1), (2023, 1)))
    assert report.status == "failed" and "other months" in report.message
    assert spark.table(trips.YELLOW_TABLE).count() == 600


def test_many_small_files_are_compacted_and_counted_once(spark, lake, tmp_path):
    yellow = lake[0].bronze[0]
    folder = tmp_path / "many" / "y_2023-01.parquet"
    folder.mkdir(parents=True)
    for i in range(12):
        pq.write_table(
            pa.table({"VendorID": pa.array([str(i), "x"])}), folder / f"{i}.parquet"
        )
    out = tmp_path / "out"
    for compact, files in ((True, 1), (False, None)):
        dataset = Dataset(yellow.contract, str(folder.parent), str(out), compact=compact)
        (report,) = run_bronze(spark, [dataset])
        assert (report.status, report.rows_read, report.rows_written) == ("lossy", 24, 24)
        assert report.values_lost == {"VendorID": 12}
        written = len(list(out.rglob("*.parquet")))
        assert written == files if files else 1 < written <= 12


def test_files_of_one_month_in_one_batch_all_survive(spark, lake, tmp_path):
    yellow = lake[0].bronze[0]
    for mark in "abc":
        (tmp_path / "same").mkdir(exist_ok=True)
        pq.write_table(
            pa.table({"VendorID": pa.array([1, 2])}), tmp_path / "same" / f"{mark}_2023-01.parquet"
        )
    dataset = Dataset(yellow.contract, str(tmp_path / "same"), str(tmp_path / "out"))
    for _ in range(2):
        (report,) = run_bronze(spark, [dataset])
        assert report.rows_written == 6
        assert spark.read.parquet(str(tmp_path / "out")).count() == 6


def test_job_script_refuses_unknown_arguments(tmp_path):
    roots = [x for n in ("landing", "bronze", "silver", "gold") for x in (f"--{n}", n)]
    for wrong in (["--steps", "bronze,lead"], ["--first", "2023-01"], ["--bronze-mode", "x"]):
        with pytest.raises(SystemExit):
            job.main([*roots, *wrong])


def test_landing_may_not_be_overwritten(spark, lake):
    yellow = lake[0].bronze[0]
    (report,) = run_bronze(spark, [Dataset(yellow.contract, yellow.landing, yellow.landing)])
    assert report.status == "failed" and "overlap" in report.message
    with pytest.raises(ValueError, match="overlap"):
        Pipeline(
            (yellow,),
            SilverLayer(trips.TRIPS, f"{yellow.location}/silver", trips.TRIP_SOURCES),
            (),
        )


def test_silver_reads_only_mapped_columns_and_does_not_shuffle(spark, lake):
    pipeline, *_ = lake
    run_pipeline(spark, pipeline)
    plan = plan_of(unified(spark, pipeline.silver))
    assert "Exchange" not in plan and "Python" not in plan
    assert "total_amount" in plan and "fare_amount" not in plan
    table = spark.table(trips.TRIPS_TABLE)
    for df in (mean_by_period(table), mean_by_hour(table)):
        plan = plan_of(df)
        assert plan.count("Exchange hashpartitioning") == 1 and "partial_avg" in plan
    assert "EqualTo(tipo_taxi,yellow)" in plan_of(mean_by_period(table))
    assert "PartitionFilters: [isnotnull(mes" in plan_of(mean_by_hour(table))


def test_every_silver_file_holds_one_kind(spark, lake):
    pipeline, *_ = lake
    run_pipeline(spark, pipeline)
    kinds = spark.table(trips.TRIPS_TABLE).groupBy("_metadata.file_path").agg(
        F.count_distinct("tipo_taxi").alias("kinds")
    )
    assert kinds.where("kinds > 1").count() == 0


def test_means_of_nulls_zeros_and_years(spark):
    df = spark.createDataFrame(
        [
            (1, "2023-05-01 07:00:00", "yellow", 1.0, 2023, 5),
            (None, "2023-05-02 07:10:00", "green", 9.0, 2023, 5),
            (4, "2022-05-02 07:59:59", "yellow", 3.0, 2022, 5),
            (0, "2023-05-02 08:00:00", "yellow", None, 2023, 5),
            (None, "2023-05-02 09:00:00", "yellow", 2.0, 2023, 5),
            (9, "2023-06-02 09:00:00", "yellow", 2.0, 2023, 6),
        ],
        "quantidade_passageiros int, t string, tipo_taxi string, valor_total double, ano int, mes int",
    ).withColumn("data_inicio_viagem", F.col("t").cast("timestamp_ntz"))
    assert rows_of(mean_by_hour(df)) == [(7, 2.5), (8, 0.0), (9, None)]
    assert rows_of(mean_by_hour(df, year=2023)) == [(7, 1.0), (8, 0.0), (9, None)]
    assert rows_of(mean_by_hour(df, month=None)) == [(7, 2.5), (8, 0.0), (9, 9.0)]
    assert rows_of(mean_by_period(df)) == [(2022, 3.0, 5), (2023, 1.5, 5), (2023, 2.0, 6)]
    assert rows_of(mean_by_period(df, kind=None)) == [(2022, 3.0, 5), (2023, 2.0, 6), (2023, 4.0, 5)]


def test_three_sources_go_together_and_types_are_checked(spark):
    contract = trips.TRIPS
    df = spark.createDataFrame([(1, 2.0, 2023, 1)], "id bigint, total double, ano int, mes int")
    mapping = {
        "id_fornecedor": "id",
        "quantidade_passageiros": "CAST(NULL AS INT)",
        "valor_total": "total",
        "data_inicio_viagem": "CAST('2023-01-01' AS TIMESTAMP_NTZ)",
        "data_fim_viagem": "CAST(NULL AS TIMESTAMP_NTZ)",
        "tipo_taxi": "'other'",
        "ano": "ano",
        "mes": "mes",
    }
    part = map_source(df, SourceMapping("x", mapping), contract)
    assert unify([part, part, part]).count() == 3
    with pytest.raises(ValueError, match="quantidade_passageiros is bigint"):
        wrong = {**mapping, "quantidade_passageiros": "id"}
        map_source(df, SourceMapping("x", wrong), contract)
    with pytest.raises(ValueError, match="no expression for ano, mes"):
        partial = {k: v for k, v in mapping.items() if k not in ("ano", "mes")}
        map_source(df, SourceMapping("x", partial), contract)
    with pytest.raises(ValueError):
        unify([])


def test_range_with_replace_all_is_refused_for_silver(spark, lake):
    with pytest.raises(ValueError, match="replace_all"):
        run_silver(spark, lake[0].silver, period=PeriodRange((2023, 1), (2023, 1)))
