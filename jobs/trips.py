"""Run the taxi pipeline: spark-submit jobs/trips.py --landing ... --bronze ... ..."""

from __future__ import annotations

import argparse
from dataclasses import replace
from typing import get_args

from pyspark.sql import SparkSession

from sedimenta.functions.period import PERIOD_IN_PATH, MonthSet, Period, PeriodRange
from sedimenta.operators.conform import Extras
from sedimenta.operators.layers import WriteMode, export_csv
from sedimenta.operators.materialize import MaterializeMode
from sedimenta.operators.validate import (
    Expectations,
    ValidationError,
    require_passed,
    validate_table,
    verdicts,
)
from sedimenta.plans.bronze import report_frame, run_bronze
from sedimenta.plans.gold import run_gold
from sedimenta.plans.pipeline import open_loads, pass_on, require_loaded
from sedimenta.plans.silver import run_silver
from sedimenta.plans.trips import trips_pipeline
from sedimenta.sources.catalog import read_table


#: Months that the validation step prints of a table; its rules look at all.
_SHOWN = 10_000


def _month(text: str) -> tuple[int, int]:
    year, month = text.split("-")
    return int(year), int(month)


def main(argv: list[str] | None = None) -> None:
    parser = argparse.ArgumentParser(description=__doc__)
    for root in ("landing", "bronze", "silver", "gold"):
        parser.add_argument(f"--{root}", required=True, help=f"root folder of {root}")
    parser.add_argument("--steps", default="bronze,silver,gold,validate", help="any of these, with commas")
    modes = get_args(WriteMode)
    parser.add_argument("--bronze-mode", default="replace_partitions", choices=modes)
    parser.add_argument(
        "--silver-mode", choices=modes, help="default: replace_all, with a range replace_partitions"
    )
    parser.add_argument("--gold-mode", default="refresh", choices=get_args(MaterializeMode))
    parser.add_argument("--first", type=_month, help="first month to load, YYYY-MM")
    parser.add_argument("--last", type=_month, help="last month to load, YYYY-MM")
    parser.add_argument("--pattern", default=PERIOD_IN_PATH, help="year and month in a path")
    parser.add_argument("--extras", default="keep", choices=get_args(Extras))
    parser.add_argument("--compact", action="store_true", help="shuffle small files together")
    parser.add_argument("--allow-rejected", action="store_true", help="go on without undated rows")
    parser.add_argument("--allow-lossy", action="store_true", help="go on where values do not fit")
    parser.add_argument("--allow-empty", action="store_true", help="go on without files of a dataset")
    parser.add_argument("--keep-unfit", action="store_true", help="keep rows whose values do not fit")
    parser.add_argument("--manifest", help="folder that remembers the files of every load")
    parser.add_argument(
        "--changed-only", action="store_true", help="load months with new or changed files only"
    )
    parser.add_argument(
        "--publish-checked", action="store_true", help="show Bronze loads to readers after a check"
    )
    parser.add_argument("--least-rows", type=int, default=0, help="rows that a month must have")
    parser.add_argument("--out-of-period", type=float, help="share of rows that may be in another month")
    parser.add_argument("--least-of-last", type=float, help="least share of the rows a month had before")
    parser.add_argument("--most-of-last", type=float, help="largest share of the rows a month had before")
    parser.add_argument("--csv", help="folder for CSV copies of the gold results")
    args = parser.parse_args(argv)
    if (args.first is None) != (args.last is None):
        parser.error("--first and --last go together")
    if args.changed_only and not args.manifest:
        parser.error("--changed-only needs --manifest")
    steps = args.steps.split(",")
    if set(steps) - {"bronze", "silver", "gold", "validate"}:
        parser.error(f"unknown step in {args.steps}")

    # Trip times carry no zone; a fixed session zone keeps every cast the same everywhere.
    spark = (
        SparkSession.builder.appName("trips")
        .config("spark.sql.session.timeZone", "UTC")
        .getOrCreate()
    )
    expected = Expectations(
        out_of_period=args.out_of_period,
        least_rows=args.least_rows,
        least_of_last=args.least_of_last,
        most_of_last=args.most_of_last,
    )
    pipeline = trips_pipeline(
        args.landing,
        args.bronze,
        args.silver,
        args.gold,
        pattern=args.pattern,
        extras=args.extras,
        compact=args.compact,
        keep_unfit=args.keep_unfit,
        manifest=args.manifest,
        expected=expected if args.publish_checked else None,
    )
    period: Period | None = PeriodRange(args.first, args.last) if args.first else None
    if "bronze" in steps:
        reports = run_bronze(spark, pipeline.bronze, args.bronze_mode, period, args.changed_only)
        report_frame(spark, reports).show(truncate=False)
        require_loaded(reports, args.allow_rejected, args.allow_lossy, args.allow_empty)
    loads, changed = open_loads(spark, pipeline)
    if args.changed_only:
        period = changed
    silver_mode = args.silver_mode or ("replace_partitions" if period else "replace_all")
    months = period if silver_mode != "replace_all" else None
    nothing = isinstance(months, MonthSet) and not months.months
    if "silver" in steps and not nothing:
        run_silver(spark, pipeline.silver, silver_mode, months)
    if "gold" in steps:
        silver_table = pipeline.silver.contract.name
        stored = run_gold(spark, pipeline.gold, silver_table, args.gold_mode, months)
        for result in pipeline.gold:
            if args.csv:
                name = result.table.split(".")[-1]
                export_csv(stored[result.table], f"{args.csv.rstrip('/')}/{name}", result.order_by)
    if {"silver", "gold"} <= set(steps) and (args.changed_only or period is None):
        pass_on(spark, loads)
    if "validate" in steps:
        faults = []
        for contract in (*(d.contract for d in pipeline.bronze), pipeline.silver.contract):
            rows = read_table(spark, contract.name)
            print(contract.name)
            counts = validate_table(rows, contract)
            counts.orderBy(*contract.partition_by).show(_SHOWN, truncate=False)
            # Sizes of the load before are known at the load only.
            rules = replace(expected, least_of_last=None, most_of_last=None)
            try:
                require_passed(verdicts(rows, contract, rules), contract.name)
            except ValidationError as error:
                faults.append(str(error))
        if faults:
            raise ValidationError("; ".join(faults))


if __name__ == "__main__":
    main()
