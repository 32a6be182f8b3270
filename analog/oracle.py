"""The same answers in plain SQL over the given tables.

Differences between the engines that the SQL spells out: a cast from double to integer
rounds there and truncates in Spark (``trunc``); year, month and hour are 64-bit there.
"""

from __future__ import annotations

_LINEITEM = (
    "l_orderkey, l_partkey, l_suppkey, l_linenumber, l_quantity, l_extendedprice, "
    "l_discount, l_tax, l_returnflag, l_linestatus, l_shipdate"
)
_PERIOD = (
    "CAST(year(l_shipdate) AS INTEGER) AS year, CAST(month(l_shipdate) AS INTEGER) AS month"
)
_FEBRUARY = "year(l_shipdate) = 1996 AND month(l_shipdate) = 2"
_TAX_TEXT = "CASE WHEN l_returnflag = 'R' THEN 'n/a' ELSE CAST(l_tax AS VARCHAR) END"
_ROWS_PER_MONTH = f"SELECT {_PERIOD}, count(*) AS n_rows FROM lineitem GROUP BY ALL"

_SILVER = f"""
SELECT l_suppkey AS provider_id, CAST(trunc(l_quantity) AS INTEGER) AS quantity,
       l_extendedprice AS amount, l_shipdate AS start_ts,
       l_shipdate + to_days(l_linenumber) AS end_ts, 'lineitem' AS kind, {_PERIOD}
FROM lineitem
UNION ALL
SELECT user_id, CAST(trunc(value) AS INTEGER), value, ts, ts, 'events',
       CAST(year(ts) AS INTEGER), CAST(month(ts) AS INTEGER)
FROM events
"""


def _monthly(kind: str) -> str:
    return f"""
WITH silver AS ({_SILVER})
SELECT year, month, round(avg(amount), 4) AS mean_amount
FROM silver WHERE kind = '{kind}' GROUP BY year, month
"""


def _hourly(where: str) -> str:
    return f"""
WITH silver AS ({_SILVER})
SELECT CAST(hour(start_ts) AS INTEGER) AS hour_of_day, round(avg(quantity), 6) AS mean_quantity
FROM silver {where} GROUP BY hour(start_ts)
"""


SQL: dict[str, str] = {
    "landing_scan": f"SELECT {_LINEITEM}, {_PERIOD} FROM lineitem",
    "period_from_path": _ROWS_PER_MONTH,
    "coerce_casts": """
SELECT CAST(l_orderkey AS VARCHAR) AS l_orderkey, CAST(l_linenumber AS DOUBLE) AS l_linenumber,
       CAST(trunc(l_quantity) AS BIGINT) AS l_quantity,
       CAST(trunc(l_extendedprice) AS INTEGER) AS l_extendedprice,
       l_tax, l_shipdate, CAST(NULL AS DOUBLE) AS l_discount
FROM lineitem
""",
    "conform_schema": """
SELECT l_orderkey, CAST(NULL AS BIGINT) AS l_partkey, CAST(NULL AS BIGINT) AS l_suppkey,
       l_linenumber, CAST(NULL AS DOUBLE) AS l_quantity, CAST(NULL AS DOUBLE) AS l_extendedprice,
       CAST(NULL AS DOUBLE) AS l_discount, CAST(NULL AS DOUBLE) AS l_tax, l_returnflag,
       CAST(NULL AS VARCHAR) AS l_linestatus, l_shipdate, l_quantity AS note
FROM lineitem
""",
    "schema_drift_ingest": f"""
SELECT l_orderkey, l_partkey, l_suppkey, l_linenumber, l_quantity, l_extendedprice, l_discount,
       CASE WHEN year(l_shipdate) < 1999 THEN l_tax END AS l_tax,
       l_returnflag, l_linestatus, l_shipdate, {_PERIOD}
FROM lineitem
""",
    "bronze_ingest": f"SELECT {_LINEITEM}, {_PERIOD} FROM lineitem",
    "write_dynamic_overwrite": _ROWS_PER_MONTH,
    "write_append": f"SELECT {_PERIOD}, 2 * count(*) AS n_rows FROM lineitem GROUP BY ALL",
    "write_static_overwrite": f"""
SELECT {_PERIOD}, count(*) AS n_rows FROM lineitem
WHERE l_shipdate >= TIMESTAMP '1998-07-01' GROUP BY ALL
""",
    "partition_reprocess": f"""
SELECT {_PERIOD}, count(*) AS n_rows FROM lineitem
WHERE l_returnflag = 'R' OR NOT (year(l_shipdate) = 1996 AND month(l_shipdate) = 2) GROUP BY ALL
""",
    "catalog_recover": _ROWS_PER_MONTH,
    "partition_filter": f"WITH silver AS ({_SILVER}) SELECT * FROM silver WHERE month = 1",
    "silver_unified": _SILVER,
    "gold_monthly_mean": _monthly("lineitem"),
    "gold_hourly_mean": _hourly("WHERE month = 1"),
    "hourly_mean_all_months": _hourly(""),
    "gold_materialize_once": _monthly("lineitem"),
    "gold_materialize_refresh": _monthly("events"),
    "csv_export": _monthly("lineitem"),
    "dataset_status": """
SELECT 'clean' AS dataset, 'ok' AS status, count(*) AS rows_read, count(*) AS rows_written,
       CAST(0 AS BIGINT) AS rows_without_period, CAST(0 AS BIGINT) AS l_tax_lost
FROM lineitem
UNION ALL
SELECT 'dirty', 'rejected', count(*), count(*) FILTER (WHERE l_linestatus <> 'F'),
       count(*) FILTER (WHERE l_linestatus = 'F'),
       count(*) FILTER (WHERE l_linestatus <> 'F' AND l_returnflag = 'R')
FROM lineitem
UNION ALL
SELECT 'lossy', 'lossy', count(*), count(*), 0, count(*) FILTER (WHERE l_returnflag = 'R')
FROM lineitem
UNION ALL
VALUES ('mistyped', 'failed', 0, 0, 0, 0), ('nothing', 'empty', 0, 0, 0, 0)
""",
    "undated_rows": f"""
SELECT * REPLACE ({_TAX_TEXT} AS l_tax), 'n' || l_linenumber AS note, 'no period' AS reason,
       'lineitem_undated.parquet' AS source_drop
FROM (SELECT {_LINEITEM} FROM lineitem WHERE l_linestatus = 'F')
""",
    "unfit_rows": f"""
SELECT l_orderkey, l_linenumber, {_TAX_TEXT} AS l_tax, 'n' || l_linenumber AS note,
       'does not fit: l_tax' AS reason
FROM lineitem WHERE l_linestatus <> 'F' AND l_returnflag = 'R'
""",
    "alternating_types": f"SELECT {_LINEITEM}, {_PERIOD} FROM lineitem",
    "extras_widened": f"""
SELECT l_orderkey, l_linenumber, {_PERIOD},
       CASE WHEN year(l_shipdate) <= 1996 THEN CAST(l_linenumber AS VARCHAR)
            WHEN year(l_shipdate) <= 1998 THEN CAST(l_quantity AS VARCHAR)
            ELSE l_returnflag END AS note,
       CASE WHEN year(l_shipdate) <= 1998 THEN CAST(l_linenumber AS DOUBLE)
            ELSE l_quantity / 4 END AS weight
FROM lineitem
""",
    "incremental_reload": f"""
SELECT {_PERIOD}, count(*) AS n_rows,
       year(l_shipdate) = 1996 AND month(l_shipdate) = 2 AS reread,
       (SELECT count(*) FROM lineitem WHERE {_FEBRUARY} AND l_returnflag = 'R') AS rows_read_again
FROM lineitem WHERE l_returnflag = 'R' OR NOT ({_FEBRUARY}) GROUP BY ALL
""",
    "append_twice_once": _ROWS_PER_MONTH,
    "validation_verdicts": f"""
WITH filed AS (
  SELECT *, {_FEBRUARY} AS misfiled FROM lineitem
), counted AS (
  SELECT CAST(year(l_shipdate) AS INTEGER) AS year,
         CAST(CASE WHEN misfiled THEN 3 ELSE month(l_shipdate) END AS INTEGER) AS month,
         count(*) AS n, count(*) FILTER (WHERE l_returnflag = 'R') AS untaxed,
         count(*) FILTER (WHERE l_extendedprice < 2000) AS cheap,
         count(*) FILTER (WHERE misfiled) AS misfiled
  FROM filed GROUP BY 1, 2
), before AS ({_ROWS_PER_MONTH}), both_loads AS (
  SELECT year, month, coalesce(n, 0) AS n, coalesce(untaxed, 0) AS untaxed, coalesce(cheap, 0) AS cheap,
         coalesce(misfiled, 0) AS misfiled, n_rows
  FROM before LEFT JOIN counted USING (year, month)
), judged AS (
  SELECT year, month, 'l_tax is null' AS rule,
         CASE WHEN n = 0 THEN 0 ELSE untaxed / n END AS measured,
         CAST(NULL AS DOUBLE) AS low, CAST(0.25 AS DOUBLE) AS high FROM both_loads
  UNION ALL
  SELECT year, month, 'cheap', CASE WHEN n = 0 THEN 0 ELSE cheap / n END, NULL, 0.01 FROM both_loads
  UNION ALL
  SELECT year, month, 'out of period', CASE WHEN n = 0 THEN 0 ELSE misfiled / n END, NULL, 0 FROM both_loads
  UNION ALL
  SELECT year, month, 'rows', n, 100, NULL FROM both_loads
  UNION ALL
  SELECT year, month, 'rows against last load', n / n_rows, 0.5, 1.5 FROM both_loads
)
SELECT year, month, rule, measured, low, high,
       coalesce(measured >= low, true) AND coalesce(measured <= high, true) AS passed
FROM judged
""",
    "staged_publish": f"""
SELECT {_PERIOD}, count(*) AS n_rows, count(l_tax) AS n_taxed, true AS refused
FROM lineitem
WHERE l_returnflag = 'R' OR NOT (year(l_shipdate) = 1996 AND month(l_shipdate) = 3) GROUP BY ALL
""",
    "gold_incremental": f"""
WITH silver AS ({_SILVER})
SELECT CAST(hour(start_ts) AS INTEGER) AS hour_of_day, kind, round(avg(quantity), 6) AS mean_quantity
FROM (
  SELECT start_ts, kind, quantity FROM silver WHERE kind = 'events'
  UNION ALL
  SELECT l_shipdate, 'lineitem', CAST(trunc(l_quantity) AS INTEGER) FROM lineitem
  WHERE l_returnflag = 'R' OR NOT ({_FEBRUARY})
) GROUP BY ALL
""",
    "grown_contract": f"SELECT {_LINEITEM}, {_PERIOD} FROM lineitem",
    "written_codec": f"""
SELECT {_PERIOD}, 'snappy' AS codec, count(*) AS n_rows FROM lineitem GROUP BY ALL
""",
    "load_stamp": f"""
SELECT {_PERIOD}, count(*) AS n_stamped, CAST(1 AS BIGINT) AS n_stamps FROM lineitem GROUP BY ALL
""",
    "csv_monthly_order": f"""
SELECT *, CAST(row_number() OVER (ORDER BY year, month) AS INTEGER) AS line
FROM ({_monthly("lineitem")})
""",
    "csv_hourly_order": f"""
SELECT *, CAST(row_number() OVER (ORDER BY hour_of_day) AS INTEGER) AS line
FROM ({_hourly("WHERE month = 1")})
""",
    "zoned_source": """
WITH local AS (
  SELECT *, (ts AT TIME ZONE 'UTC') AT TIME ZONE 'America/New_York' AS wall FROM events
)
SELECT user_id AS provider_id, CAST(trunc(value) AS INTEGER) AS quantity, value AS amount,
       wall AS start_ts, wall AS end_ts, 'events' AS kind,
       CAST(year(ts) AS INTEGER) AS year, CAST(month(ts) AS INTEGER) AS month
FROM local
""",
    "validate_table": """
WITH filed AS (
  SELECT *, year(l_shipdate) = 1996 AND month(l_shipdate) = 2 AS misfiled FROM lineitem
)
SELECT CAST(year(l_shipdate) AS INTEGER) AS year,
       CAST(CASE WHEN misfiled THEN 3 ELSE month(l_shipdate) END AS INTEGER) AS month,
       count(*) AS "rows", count(l_orderkey) AS l_orderkey_count,
       count(l_partkey) AS l_partkey_count, count(l_suppkey) AS l_suppkey_count,
       count(l_linenumber) AS l_linenumber_count, count(l_quantity) AS l_quantity_count,
       count(l_extendedprice) AS l_extendedprice_count, count(l_discount) AS l_discount_count,
       count(*) FILTER (WHERE l_returnflag <> 'R') AS l_tax_count,
       count(l_returnflag) AS l_returnflag_count, count(l_linestatus) AS l_linestatus_count,
       count(l_shipdate) AS l_shipdate_count,
       count(*) FILTER (WHERE misfiled) AS rows_out_of_period
FROM filed GROUP BY ALL
""",
    "all_layers": _monthly("lineitem"),
}
