"""Configuration for New York taxi trips: yellow and green files, one table of all trips."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sedimenta.contracts import TableContract
from sedimenta.functions.period import PERIOD_IN_PATH
from sedimenta.operators.conform import Extras
from sedimenta.operators.means import mean_by_hour, mean_by_period, mean_states, merged_mean
from sedimenta.operators.unify import SourceMapping
from sedimenta.operators.validate import Expectations
from sedimenta.plans.bronze import Dataset
from sedimenta.plans.gold import GoldResult, IncrementalResult
from sedimenta.plans.pipeline import Pipeline
from sedimenta.plans.silver import SilverLayer

_TYPES = {
    "bigint": T.LongType(),
    "int": T.IntegerType(),
    "double": T.DoubleType(),
    "string": T.StringType(),
    "time": T.TimestampNTZType(),  # wall-clock time of the trip, without a zone
}


def _columns(text: str) -> T.StructType:
    pairs = (line.split() for line in text.strip().splitlines())
    return T.StructType([T.StructField(name, _TYPES[kind]) for name, kind in pairs])


# Table names, column names and types that stored tables and queries rely on.
YELLOW_TABLE = "dados_taxi_bronze.taxi_yellow"
GREEN_TABLE = "dados_taxi_bronze.taxi_green"
TRIPS_TABLE = "dados_taxi_silver.corridas_taxi"
MONTHLY_MEAN_TABLE = "dados_taxi_gold.media_valor_total_mes_yellow"
HOURLY_MEAN_TABLE = "dados_taxi_gold.media_passageiros_hora_maio"

YELLOW_COLUMNS = _columns("""
    VendorID               bigint
    tpep_pickup_datetime   time
    tpep_dropoff_datetime  time
    passenger_count        bigint
    trip_distance          double
    RatecodeID             double
    store_and_fwd_flag     string
    PULocationID           bigint
    DOLocationID           bigint
    payment_type           double
    fare_amount            double
    extra                  double
    mta_tax                double
    tip_amount             double
    tolls_amount           double
    improvement_surcharge  double
    total_amount           double
    congestion_surcharge   double
    airport_fee            double
""")

GREEN_COLUMNS = _columns("""
    VendorID               bigint
    lpep_pickup_datetime   time
    lpep_dropoff_datetime  time
    store_and_fwd_flag     string
    RatecodeID             double
    PULocationID           bigint
    DOLocationID           bigint
    passenger_count        double
    trip_distance          double
    fare_amount            double
    extra                  double
    mta_tax                double
    tip_amount             double
    tolls_amount           double
    ehail_fee              string
    improvement_surcharge  double
    total_amount           double
    payment_type           double
    trip_type              double
    congestion_surcharge   double
""")

TRIPS_COLUMNS = _columns("""
    id_fornecedor           bigint
    quantidade_passageiros  int
    valor_total             double
    data_inicio_viagem      time
    data_fim_viagem         time
    tipo_taxi               string
""")
# End of the fixed values.

YELLOW = TableContract(
    YELLOW_TABLE, YELLOW_COLUMNS, loaded_at="ingestion_ts", event_time="tpep_pickup_datetime"
)
GREEN = TableContract(
    GREEN_TABLE, GREEN_COLUMNS, loaded_at="ingestion_ts", event_time="lpep_pickup_datetime"
)
TRIPS = TableContract(TRIPS_TABLE, TRIPS_COLUMNS, event_time="data_inicio_viagem")


def _trips_from(table: str, kind: str, pickup: str, dropoff: str) -> SourceMapping:
    return SourceMapping(
        table,
        {
            "id_fornecedor": "VendorID",
            "quantidade_passageiros": "try_cast(passenger_count AS INT)",
            "valor_total": "total_amount",
            "data_inicio_viagem": pickup,
            "data_fim_viagem": dropoff,
            "tipo_taxi": f"'{kind}'",
            "ano": "ano",
            "mes": "mes",
        },
    )


TRIP_SOURCES = (
    _trips_from(YELLOW_TABLE, "yellow", "tpep_pickup_datetime", "tpep_dropoff_datetime"),
    _trips_from(GREEN_TABLE, "green", "lpep_pickup_datetime", "lpep_dropoff_datetime"),
)


def _monthly_states(trips: DataFrame) -> DataFrame:
    return mean_states(trips, "valor_total", [F.col("tipo_taxi")])


def _hourly_states(trips: DataFrame) -> DataFrame:
    hour = F.hour("data_inicio_viagem").alias("hora_do_dia")
    return mean_states(trips, "quantidade_passageiros", [hour])


def _gold(gold: str, incremental: bool) -> tuple[GoldResult | IncrementalResult, ...]:
    monthly = (MONTHLY_MEAN_TABLE, f"{gold}/media_valor_total_mes_yellow")
    hourly = (HOURLY_MEAN_TABLE, f"{gold}/media_passageiros_hora_maio")
    if not incremental:
        return (
            GoldResult(*monthly, mean_by_period, ("ano", "mes")),
            GoldResult(*hourly, mean_by_hour, ("hora_do_dia",)),
        )
    return (
        IncrementalResult(
            *monthly,
            _monthly_states,
            lambda s: merged_mean(s.where("tipo_taxi = 'yellow'"), ("ano", "mes"), "media_valor_total"),
            ("ano", "mes"),
        ),
        IncrementalResult(
            *hourly,
            _hourly_states,
            lambda s: merged_mean(s.where("mes = 5"), ("hora_do_dia",), "media_passageiros"),
            ("hora_do_dia",),
        ),
    )


def trips_pipeline(
    landing: str,
    bronze: str,
    silver: str,
    gold: str,
    pattern: str = PERIOD_IN_PATH,
    extras: Extras = "keep",
    compact: bool = False,
    keep_unfit: bool = False,
    manifest: str | None = None,
    expected: Expectations | None = None,
) -> Pipeline:
    """The taxi pipeline below four root folders; landing holds ``yellow`` and ``green``.

    ``manifest`` is a fifth one, for runs over changed files only; the results then are put together
    from stored states. With ``expected`` Bronze loads are published after a check.
    """
    landing, bronze, silver, gold = (p.rstrip("/") for p in (landing, bronze, silver, gold))

    def dataset(contract: TableContract, folder: str, table: str) -> Dataset:
        return Dataset(
            contract,
            f"{landing}/{folder}",
            f"{bronze}/{table}",
            pattern=pattern,
            extras=extras,
            compact=compact,
            keep_unfit=keep_unfit,
            manifest=f"{manifest.rstrip('/')}/{table}" if manifest else None,
            expected=expected,
        )

    return Pipeline(
        bronze=(dataset(YELLOW, "yellow", "taxi_yellow"), dataset(GREEN, "green", "taxi_green")),
        silver=SilverLayer(TRIPS, f"{silver}/corridas_taxi", TRIP_SOURCES),
        gold=_gold(gold, incremental=manifest is not None),
    )
