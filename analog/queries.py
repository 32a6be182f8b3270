"""One query per operator, all over whole tables."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import replace

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from analog.tables import (
    EVENTS_MAPPING,
    LINEITEM_COLUMNS,
    PERIOD,
    Lake,
    lake,
    lineitem_contract,
    monthly_drop,
    stage,
)
from sedimenta.functions.period import PeriodRange
from sedimenta.operators.conform import conform, conform_all
from sedimenta.operators.layers import export_csv, reprocess_partition, write_layer
from sedimenta.operators.materialize import materialize
from sedimenta.operators.means import mean_by_hour, mean_by_period, mean_states, merged_mean
from sedimenta.operators.unify import SourceMapping, map_source
from sedimenta.operators.validate import Expectations, Rule, ValidationError, nulls, row_counts, verdicts
from sedimenta.operators.validate import validate_table as validate
from sedimenta.plans.bronze import ingest, report_frame, run_bronze
from sedimenta.plans.gold import GoldResult, IncrementalResult
from sedimenta.plans.pipeline import Pipeline, run_pipeline
from sedimenta.plans.silver import unified
from sedimenta.sources.catalog import ensure_table, read_table, recover
from sedimenta.sources.landing import scan
from sedimenta.sources.rejects import rejected

def _monthly(df: DataFrame, kind: str = "lineitem") -> DataFrame:
    means = mean_by_period(df, "amount", kind, "kind", PERIOD, "mean_amount")
    return means.withColumn("mean_amount", F.round("mean_amount", 4))


def _hourly(df: DataFrame, month: int | None) -> DataFrame:
    means = mean_by_hour(
        df, "quantity", "start_ts", month, None, PERIOD, "hour_of_day", "mean_quantity"
    )
    return means.withColumn("mean_quantity", F.round("mean_quantity", 6))


def _rows_per_month(df: DataFrame) -> DataFrame:
    return df.groupBy(*PERIOD).agg(F.count("*").alias("n_rows"))


def landing_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    at = lake(spark, sf_dir)
    contract = lineitem_contract("lineitem")
    return conform_all(scan(spark, at.lineitem_landing, contract).groups, contract).rows


def period_from_path(spark: SparkSession, sf_dir: str) -> DataFrame:
    at = lake(spark, sf_dir)
    (rows,) = scan(spark, at.lineitem_landing, lineitem_contract("lineitem")).groups
    return _rows_per_month(rows)


def coerce_casts(spark: SparkSession, sf_dir: str) -> DataFrame:
    source = lake(spark, sf_dir).table("lineitem").select(
        "l_orderkey",
        "l_linenumber",
        "l_quantity",
        "l_extendedprice",
        F.col("l_tax").cast("string").alias("L_TAX"),
        F.col("l_shipdate").cast("string").alias("l_shipdate"),
        F.col("l_returnflag").alias("l_discount"),
    )
    declared = T.StructType(
        [
            T.StructField("l_orderkey", T.StringType()),
            T.StructField("l_linenumber", T.DoubleType()),
            T.StructField("l_quantity", T.LongType()),
            T.StructField("l_extendedprice", T.IntegerType()),
            T.StructField("l_tax", T.DoubleType()),
            T.StructField("l_shipdate", T.TimestampNTZType()),
            T.StructField("l_discount", T.DoubleType()),
        ]
    )
    return conform(source, declared, "drop")


def conform_schema(spark: SparkSession, sf_dir: str) -> DataFrame:
    partial = lake(spark, sf_dir).table("lineitem").select(
        F.col("l_quantity").alias("note"),
        "l_shipdate",
        F.col("l_linenumber").cast("bigint").alias("L_LineNumber"),
        "l_orderkey",
        "l_returnflag",
    )
    return conform(partial, LINEITEM_COLUMNS, "keep")


def _stage_drift(whole: DataFrame, landing: str) -> None:
    """Three spans of years: line number as bigint, as double, as int without a tax column."""
    drop = monthly_drop("lineitem", "l_shipdate")
    year = F.year("l_shipdate")
    number = F.col("l_linenumber")
    first = whole.where(year <= 1996).withColumn("l_linenumber", number.cast("bigint"))
    second = whole.where(year.between(1997, 1998)).withColumn(
        "l_linenumber", number.cast("double")
    )
    third = whole.where(year >= 1999).drop("l_tax")
    for span in (first, second, third):
        stage(span, landing, drop, "append")


def schema_drift_ingest(spark: SparkSession, sf_dir: str) -> DataFrame:
    at = lake(spark, sf_dir)
    landing = at.landing("drift", lambda to: _stage_drift(at.table("lineitem"), to))
    dataset = at.lineitem_dataset("drifted", landing)
    ingest(spark, dataset)
    return spark.table(dataset.contract.name).drop("ingestion_ts")


def bronze_ingest(spark: SparkSession, sf_dir: str) -> DataFrame:
    dataset = lake(spark, sf_dir).lineitem_dataset("ingested")
    ingest(spark, dataset)
    return spark.table(dataset.contract.name).drop("ingestion_ts")


def write_dynamic_overwrite(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two batches that together hold every month, the first one twice."""
    at = lake(spark, sf_dir)
    dataset = at.lineitem_dataset("replaced")
    year, month = F.year("l_shipdate"), F.month("l_shipdate")
    present = at.table("lineitem").agg(F.min(F.struct(year, month)), F.max(F.struct(year, month)))
    first, last = (tuple(bound) for bound in present.first())
    middle = ((first[0] + last[0]) // 2, 6)
    early, late = PeriodRange(first, middle), PeriodRange((middle[0], 7), last)
    for months in (early, late, early):
        ingest(spark, dataset, "replace_partitions", months)
    return _rows_per_month(spark.table(dataset.contract.name))


def write_append(spark: SparkSession, sf_dir: str) -> DataFrame:
    dataset = lake(spark, sf_dir).lineitem_dataset("appended")
    for _ in range(2):
        ingest(spark, dataset, "append")
    return _rows_per_month(spark.table(dataset.contract.name))


def write_static_overwrite(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two landings one after the other into one table: all that is left is the second."""
    at = lake(spark, sf_dir)
    later = at.landing("later", lambda to: _stage_later(at.table("lineitem"), to))
    whole = at.lineitem_dataset("rewritten")
    ingest(spark, whole, "replace_all")
    ingest(spark, replace(whole, landing=later), "replace_all")
    return _rows_per_month(spark.table(whole.contract.name))


def _stage_later(whole: DataFrame, landing: str) -> None:
    shipped = F.col("l_shipdate")
    later = (F.year(shipped) > 1998) | (F.year(shipped) == 1998) & (F.month(shipped) >= 7)
    stage(whole.where(later), landing, monthly_drop("lineitem", "l_shipdate"))


def partition_reprocess(spark: SparkSession, sf_dir: str) -> DataFrame:
    at = lake(spark, sf_dir)
    dataset = at.lineitem_dataset("reprocessed")
    ingest(spark, dataset)
    months = PeriodRange((1996, 2), (1996, 2))
    again = conform_all(
        scan(spark, at.lineitem_landing, dataset.contract, period=months).groups, dataset.contract
    ).rows
    returned = again.where("l_returnflag = 'R'").withColumn("ingestion_ts", F.current_timestamp())
    reprocess_partition(spark, dataset.contract.name, {"year": 1996, "month": 2}, returned)
    return _rows_per_month(spark.table(dataset.contract.name))


def catalog_recover(spark: SparkSession, sf_dir: str) -> DataFrame:
    at = lake(spark, sf_dir)
    location, table = at.fresh("recovered")
    contract = lineitem_contract(table)
    rows = conform_all(scan(spark, at.lineitem_landing, contract).groups, contract).rows
    write_layer(rows, location, PERIOD)
    ensure_table(spark, contract, location)
    recover(spark, table)
    return _rows_per_month(read_table(spark, table))


def partition_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lake(spark, sf_dir).silver_table().where("month = 1")


def silver_unified(spark: SparkSession, sf_dir: str) -> DataFrame:
    at = lake(spark, sf_dir)
    return unified(spark, at.silver_layer(at.bronze))


def gold_monthly_mean(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _monthly(lake(spark, sf_dir).silver_table())


def gold_hourly_mean(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _hourly(lake(spark, sf_dir).silver_table(), month=1)


def hourly_mean_all_months(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _hourly(lake(spark, sf_dir).silver_table(), month=None)


def _materialize_twice(spark: SparkSession, sf_dir: str, mode: str) -> DataFrame:
    at = lake(spark, sf_dir)
    location, table = at.fresh(f"means_{mode}")
    materialize(_monthly(at.silver_table(), "lineitem"), table, location, mode)
    return materialize(_monthly(at.silver_table(), "events"), table, location, mode)


def gold_materialize_once(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _materialize_twice(spark, sf_dir, "once")


def gold_materialize_refresh(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _materialize_twice(spark, sf_dir, "refresh")


def csv_export(spark: SparkSession, sf_dir: str) -> DataFrame:
    at = lake(spark, sf_dir)
    location, _ = at.fresh("csv")
    export_csv(_monthly(at.silver_table()), location, PERIOD)
    return spark.read.option("header", True).csv(
        location, schema="year INT, month INT, mean_amount DOUBLE"
    )


def _stage_dirty(whole: DataFrame, landing: str) -> None:
    """Tax as text, unreadable in returned lines; finished lines under a name without a month; a
    column that is not declared."""
    tax = F.when(F.col("l_returnflag") == "R", "n/a").otherwise(F.col("l_tax").cast("string"))
    stage(
        whole.withColumn("l_tax", tax).withColumn("note", F.concat(F.lit("n"), "l_linenumber")),
        landing,
        F.when(F.col("l_linestatus") == "F", "lineitem_undated.parquet").otherwise(
            monthly_drop("lineitem", "l_shipdate")
        ),
    )


def _stage_mistyped(whole: DataFrame, landing: str) -> None:
    drop = monthly_drop("lineitem", "l_shipdate")
    stage(whole.withColumn("l_tax", F.array("l_tax")), landing, drop)


def _stage_lossy(whole: DataFrame, landing: str) -> None:
    """Tax as text, unreadable in returned lines; every name has its month."""
    tax = F.when(F.col("l_returnflag") == "R", "n/a").otherwise(F.col("l_tax").cast("string"))
    stage(whole.withColumn("l_tax", tax), landing, monthly_drop("lineitem", "l_shipdate"))


def _dirty(at: Lake) -> str:
    return at.landing("dirty", lambda to: _stage_dirty(at.table("lineitem"), to))


def dataset_status(spark: SparkSession, sf_dir: str) -> DataFrame:
    at = lake(spark, sf_dir)
    datasets = {
        "clean": at.lineitem_landing,
        "dirty": _dirty(at),
        "lossy": at.landing("lossy", lambda to: _stage_lossy(at.table("lineitem"), to)),
        "mistyped": at.landing("mistyped", lambda to: _stage_mistyped(at.table("lineitem"), to)),
        "nothing": at.landing("nothing", lambda to: None),
    }
    reports = run_bronze(
        spark, [at.lineitem_dataset(label, landing) for label, landing in datasets.items()]
    )
    return report_frame(spark, reports).select(
        F.regexp_extract("dataset", r"\.([a-z]+)_", 1).alias("dataset"),
        "status",
        "rows_read",
        "rows_written",
        "rows_without_period",
        F.coalesce(F.col("values_lost")["l_tax"], F.lit(0).cast("bigint")).alias("l_tax_lost"),
    )


def undated_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rejected rows, as they came, of a landing in which one drop names no month."""
    at = lake(spark, sf_dir)
    dataset = at.lineitem_dataset("undated", _dirty(at))
    report = ingest(spark, dataset)
    rows = rejected(spark, dataset.reject_folder, report.load)
    source = F.regexp_extract("source_path", r"([^/=]+\.parquet)/", 1).alias("source_drop")
    return rows.select("row.*", "reason", source)


def unfit_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows of dated drops of which a value does not fit, as they came."""
    at = lake(spark, sf_dir)
    dataset = replace(at.lineitem_dataset("unfit", _dirty(at)), keep_unfit=True)
    report = ingest(spark, dataset)
    rows = rejected(spark, dataset.reject_folder, report.load).where("reason <> 'no period'")
    return rows.select("row.l_orderkey", "row.l_linenumber", "row.l_tax", "row.note", "reason")


def grown_contract(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A table loaded without two columns of its source; the contract gains them, a load fills them."""
    at = lake(spark, sf_dir)
    whole = at.lineitem_dataset("grown")
    fewer = T.StructType([f for f in LINEITEM_COLUMNS if f.name not in ("l_tax", "l_discount")])
    ingest(spark, replace(whole, contract=replace(whole.contract, columns=fewer), extras="drop"))
    ingest(spark, replace(whole, grow=True))
    return spark.table(whole.contract.name).drop("ingestion_ts")


def written_codec(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows by month and by the codec that their file names."""
    dataset = lake(spark, sf_dir).lineitem_dataset("coded")
    ingest(spark, dataset)
    rows = spark.read.parquet(dataset.location)
    codec = F.regexp_extract("_metadata.file_name", r"\.([a-z0-9]+)\.parquet$", 1)
    return rows.groupBy(*PERIOD, codec.alias("codec")).agg(F.count("*").alias("n_rows"))


def load_stamp(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Stamped rows and distinct stamps of every month after one load."""
    dataset = lake(spark, sf_dir).lineitem_dataset("stamped")
    ingest(spark, dataset)
    stamp = F.col("ingestion_ts")
    return (
        spark.table(dataset.contract.name)
        .groupBy(*PERIOD)
        .agg(F.count(stamp).alias("n_stamped"), F.count_distinct(stamp).alias("n_stamps"))
    )


def _lines(spark: SparkSession, location: str, schema: str) -> DataFrame:
    """Rows of an exported result with their line numbers, files in order by name."""
    rows = spark.read.option("header", True).csv(location, schema=schema)
    at = Window.orderBy("file", "place")
    placed = rows.select(
        "*", F.col("_metadata.file_name").alias("file"), F.monotonically_increasing_id().alias("place")
    )
    return placed.withColumn("line", F.row_number().over(at)).drop("file", "place")


def csv_monthly_order(spark: SparkSession, sf_dir: str) -> DataFrame:
    at = lake(spark, sf_dir)
    location, _ = at.fresh("csv_months")
    export_csv(_monthly(at.silver_table()), location, PERIOD)
    return _lines(spark, location, "year INT, month INT, mean_amount DOUBLE")


def csv_hourly_order(spark: SparkSession, sf_dir: str) -> DataFrame:
    at = lake(spark, sf_dir)
    location, _ = at.fresh("csv_hours")
    export_csv(_hourly(at.silver_table(), month=1), location, ("hour_of_day",))
    return _lines(spark, location, "hour_of_day INT, mean_quantity DOUBLE")


def zoned_source(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A source whose times carry a zone, unified as wall-clock times of New York."""
    at = lake(spark, sf_dir)
    contract = at.silver_layer(at.bronze).contract
    zoned = at.table("events").select(
        "user_id",
        "value",
        F.col("ts").cast("timestamp").alias("ts"),
        F.year("ts").alias("year"),
        F.month("ts").alias("month"),
    )
    return map_source(zoned, SourceMapping("events", EVENTS_MAPPING, "America/New_York"), contract)


def _stage_misfiled(whole: DataFrame, landing: str) -> None:
    """Rows of February 1996 filed under March; no tax in returned lines."""
    shipped = F.col("l_shipdate")
    february = (F.year(shipped) == 1996) & (F.month(shipped) == 2)
    stage(
        whole.withColumn("l_tax", F.when(F.col("l_returnflag") != "R", F.col("l_tax"))),
        landing,
        F.when(february, "lineitem_1996-03.parquet").otherwise(
            monthly_drop("lineitem", "l_shipdate")
        ),
    )


def validate_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    at = lake(spark, sf_dir)
    landing = at.landing("misfiled", lambda to: _stage_misfiled(at.table("lineitem"), to))
    dataset = at.lineitem_dataset("misfiled", landing)
    ingest(spark, dataset)
    return validate(spark.table(dataset.contract.name), dataset.contract)


def all_layers(spark: SparkSession, sf_dir: str) -> DataFrame:
    at = lake(spark, sf_dir)
    datasets = (at.lineitem_dataset("lineitem"), at.events_dataset("events"))
    location, table = at.fresh("monthly_mean")
    result = GoldResult(table, location, _monthly, PERIOD)
    run = run_pipeline(spark, Pipeline(datasets, at.silver_layer(datasets), (result,)))
    return run.gold[table]


def _stage_alternating(whole: DataFrame, landing: str) -> None:
    """Line number as bigint in odd months and as double in even ones."""
    drop, number = monthly_drop("lineitem", "l_shipdate"), F.col("l_linenumber")
    odd = F.month("l_shipdate") % 2 == 1
    stage(whole.where(odd).withColumn("l_linenumber", number.cast("bigint")), landing, drop, "append")
    stage(whole.where(~odd).withColumn("l_linenumber", number.cast("double")), landing, drop, "append")


def alternating_types(spark: SparkSession, sf_dir: str) -> DataFrame:
    at = lake(spark, sf_dir)
    landing = at.landing("alternating", lambda to: _stage_alternating(at.table("lineitem"), to))
    dataset = at.lineitem_dataset("alternated", landing)
    ingest(spark, dataset)
    return spark.table(dataset.contract.name).drop("ingestion_ts")


def _stage_extras(whole: DataFrame, landing: str) -> None:
    """Two undeclared columns whose types change: whole numbers, floating ones, and text."""
    drop, year = monthly_drop("lineitem", "l_shipdate"), F.year("l_shipdate")
    spans = (
        (year <= 1996, "l_linenumber", F.col("l_linenumber")),
        (year.between(1997, 1998), "l_quantity", F.col("l_linenumber").cast("bigint")),
        (year >= 1999, "l_returnflag", F.col("l_quantity") / 4),
    )
    for span, note, weight in spans:
        stage(whole.where(span).withColumns({"note": F.col(note), "weight": weight}), landing, drop, "append")


def extras_widened(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Undeclared columns of several types: one type for all rows."""
    at = lake(spark, sf_dir)
    landing = at.landing("extras", lambda to: _stage_extras(at.table("lineitem"), to))
    dataset = at.lineitem_dataset("widened", landing)
    ingest(spark, dataset)
    rows = spark.read.parquet(dataset.location)
    return rows.select("l_orderkey", "l_linenumber", "note", "weight", *PERIOD)


def _replace_drop(rows: DataFrame, landing: str) -> None:
    """The drops of these rows hold them and nothing else from now on."""
    dealt = rows.withColumn("drop", monthly_drop("lineitem", "l_shipdate"))
    writer = dealt.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
    writer.partitionBy("drop").parquet(landing)


def _of(year: int, month: int):
    shipped = F.col("l_shipdate")
    return (F.year(shipped) == year) & (F.month(shipped) == month)


def _own_landing(at: Lake, label: str) -> str:
    """Lineitem drops that a query may change."""
    landing, _ = at.fresh(f"landing_{label}")
    stage(at.table("lineitem"), landing, monthly_drop("lineitem", "l_shipdate"))
    return landing


def incremental_reload(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two loads, the second after one drop has changed: rows of every month, and whether the second
    load has written it."""
    at = lake(spark, sf_dir)
    landing = _own_landing(at, "reload")
    dataset = replace(at.lineitem_dataset("reloaded", landing), manifest=at.fresh("manifest")[0])
    ingest(spark, dataset)
    _replace_drop(at.table("lineitem").where(_of(1996, 2) & (F.col("l_returnflag") == "R")), landing)
    again = ingest(spark, dataset, changed_only=True)
    stamps = spark.table(dataset.contract.name).groupBy(*PERIOD).agg(
        F.count("*").alias("n_rows"), F.min("ingestion_ts").alias("at")
    )
    first = stamps.agg(F.min("at")).first()[0]
    return stamps.select(*PERIOD, "n_rows", (F.col("at") > F.lit(first)).alias("reread")).withColumn(
        "rows_read_again", F.lit(again.rows_read).cast("bigint")
    )


def append_twice_once(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The early months appended, then all of them, then all again: each row once."""
    at = lake(spark, sf_dir)
    dataset = at.lineitem_dataset("keyed")
    dataset = replace(dataset, contract=replace(dataset.contract, file_key="file_key"))
    for months in (PeriodRange((1990, 1), (1997, 6)), None, None):
        ingest(spark, dataset, "append", months)
    return _rows_per_month(spark.table(dataset.contract.name))


def validation_verdicts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rules on a table with misfiled rows, its sizes compared with those of a clean load."""
    at = lake(spark, sf_dir)
    landing = at.landing("misfiled", lambda to: _stage_misfiled(at.table("lineitem"), to))
    dataset = at.lineitem_dataset("judged", landing)
    ingest(spark, dataset)
    clean = spark.table(at.bronze[0].contract.name)
    expected = Expectations(
        rules=(nulls("l_tax", 0.25), Rule("cheap", "l_extendedprice < 2000", 0.01)),
        out_of_period=0.0,
        least_rows=100,
        least_of_last=0.5,
        most_of_last=1.5,
    )
    return verdicts(spark.table(dataset.contract.name), dataset.contract, expected, row_counts(clean, dataset.contract))


def staged_publish(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Three loads, each published after a check: all months, one month that fails, one that passes."""
    at = lake(spark, sf_dir)
    whole = at.table("lineitem")
    expected = Expectations(rules=(nulls("l_tax", 0.5),), least_rows=1)
    dataset = replace(at.lineitem_dataset("published"), expected=expected)
    ingest(spark, dataset, "replace_all")
    untaxed, returned = at.fresh("untaxed")[0], at.fresh("returned")[0]
    drop = monthly_drop("lineitem", "l_shipdate")
    stage(whole.where(_of(1996, 2)).withColumn("l_tax", F.lit(None).cast("double")), untaxed, drop)
    stage(whole.where(_of(1996, 3) & (F.col("l_returnflag") == "R")), returned, drop)
    try:
        ingest(spark, replace(dataset, landing=untaxed))
    except ValidationError:
        refused = True
    else:
        refused = False
    ingest(spark, replace(dataset, landing=returned))
    rows = spark.table(dataset.contract.name).groupBy(*PERIOD)
    return rows.agg(F.count("*").alias("n_rows"), F.count("l_tax").alias("n_taxed")).withColumn(
        "refused", F.lit(refused)
    )


def gold_incremental(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Means per hour and kind over all months, from stored states, after one month has changed."""
    at = lake(spark, sf_dir)
    landing = _own_landing(at, "incremental")
    lineitem = replace(at.lineitem_dataset("lineitem", landing), manifest=at.fresh("manifest")[0])
    events = replace(at.events_dataset("events"), manifest=at.fresh("manifest")[0])
    location, table = at.fresh("hourly_mean")
    keys = ("hour_of_day", "kind")
    result = IncrementalResult(
        table,
        location,
        lambda df: mean_states(df, "quantity", [F.hour("start_ts").alias("hour_of_day"), F.col("kind")], PERIOD),
        lambda states: merged_mean(states, keys, "mean_quantity"),
        keys,
        PERIOD,
    )
    datasets = (lineitem, events)
    pipeline = Pipeline(datasets, at.silver_layer(datasets), (result,))
    run_pipeline(spark, pipeline)
    _replace_drop(at.table("lineitem").where(_of(1996, 2) & (F.col("l_returnflag") == "R")), landing)
    run = run_pipeline(spark, pipeline, changed_only=True)
    return run.gold[table].withColumn("mean_quantity", F.round("mean_quantity", 6))


ALL: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    query.__name__: query
    for query in (
        landing_scan,
        period_from_path,
        coerce_casts,
        conform_schema,
        schema_drift_ingest,
        bronze_ingest,
        write_dynamic_overwrite,
        write_append,
        write_static_overwrite,
        partition_reprocess,
        catalog_recover,
        partition_filter,
        silver_unified,
        gold_monthly_mean,
        gold_hourly_mean,
        hourly_mean_all_months,
        gold_materialize_once,
        gold_materialize_refresh,
        csv_export,
        dataset_status,
        undated_rows,
        unfit_rows,
        alternating_types,
        extras_widened,
        incremental_reload,
        append_twice_once,
        validation_verdicts,
        staged_publish,
        gold_incremental,
        grown_contract,
        written_codec,
        load_stamp,
        csv_monthly_order,
        csv_hourly_order,
        zoned_source,
        validate_table,
        all_layers,
    )
}
