"""What has been loaded: one row per landing file and load.

A load first writes the files that it is going to read, with their fingerprints, then its table,
and last one row that says it is done. Files of a load without that row count as not loaded: a load
that was cut off is done again. Another row says that later layers have its months, so that a run
that was cut off behind Bronze is caught up by the next.
"""

from __future__ import annotations

from dataclasses import dataclass
from typing import Literal

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sedimenta.sources.footers import FINGERPRINT

#: ``month``: every file of a month of which a file has changed; ``file``: changed files alone.
Unit = Literal["month", "file"]

STATE = T.StructType(
    [
        T.StructField("path", T.StringType()),
        T.StructField("bytes", T.LongType()),
        T.StructField("modified", T.TimestampType()),
        T.StructField("year", T.IntegerType()),
        T.StructField("month", T.IntegerType()),
        T.StructField(FINGERPRINT, T.StringType()),
    ]
)
_DONE = T.StructType(
    [T.StructField("load", T.StringType()), T.StructField("done_at", T.TimestampType())]
)


def _table(spark: SparkSession, folder: str, schema: T.StructType) -> DataFrame:
    try:
        return spark.read.schema(schema).parquet(folder)
    except AnalysisException as error:
        if error.getCondition() == "PATH_NOT_FOUND":
            return spark.createDataFrame([], schema)
        raise


@dataclass(frozen=True)
class Manifest:
    """The folder of a dataset's loads."""

    folder: str

    def files_of(self, load: str, kind: str = "read") -> str:
        """Folder of the files that a load reads, or of those that it found ``gone``."""
        return f"{self.folder.rstrip('/')}/files/load={load}/kind={kind}"

    @property
    def _done(self) -> str:
        return f"{self.folder.rstrip('/')}/done"

    def known(self, spark: SparkSession) -> DataFrame:
        """The last loaded state of every file that is still there; see STATE."""
        with_load = T.StructType([*STATE.fields, T.StructField("load", T.StringType())])
        files = _table(spark, f"{self.folder.rstrip('/')}/files", with_load)
        done = _table(spark, self._done, _DONE).groupBy("load").agg(F.max("done_at").alias("done_at"))
        state = F.struct(*(f.name for f in STATE.fields if f.name != "path")).alias("state")
        last = files.join(done, "load").groupBy("path").agg(
            F.max_by(state, F.struct("done_at", "load")).alias("state")
        )
        # A file that was gone has no size.
        return last.select("path", "state.*").where("bytes IS NOT NULL").select(*STATE.names)

    def done(self, spark: SparkSession, load: str) -> None:
        self._note(spark, self._done, load)

    def passed_on(self, spark: SparkSession, load: str) -> None:
        """Later layers have what the load has written."""
        self._note(spark, self._passed_on, load)

    def open_loads(self, spark: SparkSession) -> dict[str, frozenset[tuple[int, int]]]:
        """Loads that are done but not passed on to later layers, with their months."""
        schema = T.StructType([*STATE.fields, T.StructField("load", T.StringType())])
        files = _table(spark, f"{self.folder.rstrip('/')}/files", schema)
        done = _table(spark, self._done, _DONE).select("load").distinct()
        left = done.join(_table(spark, self._passed_on, _DONE).select("load"), "load", "left_anti")
        months = F.collect_set(F.when(F.col("month").isNotNull(), F.struct("year", "month")))
        rows = left.join(files, "load", "left").groupBy("load").agg(months.alias("months")).collect()
        return {r["load"]: frozenset(tuple(m) for m in r["months"]) for r in rows}

    @property
    def _passed_on(self) -> str:
        return f"{self.folder.rstrip('/')}/passed_on"

    def _note(self, spark: SparkSession, folder: str, load: str) -> None:
        row = spark.sql("SELECT :load AS load, current_timestamp() AS done_at", args={"load": load})
        row.write.mode("append").parquet(folder)


def changes(listed: DataFrame, known: DataFrame) -> DataFrame:
    """Files that are new, changed or gone: path, year, month, gone.

    Months are those of the listing, of a gone file those of its load.
    """
    before = known.select(
        F.col("path").alias("__path"),
        F.col("bytes").alias("__bytes"),
        F.col("modified").alias("__modified"),
        F.col("year").alias("__year"),
        F.col("month").alias("__month"),
    )
    both = listed.join(before, F.col("path") == F.col("__path"), "full")
    same = (F.col("bytes") == F.col("__bytes")) & (F.col("modified") == F.col("__modified"))
    gone = F.col("path").isNull()
    return both.where(~F.coalesce(same, F.lit(False))).select(
        F.coalesce("path", "__path").alias("path"),
        F.when(gone, F.col("__year")).otherwise(F.col("year")).alias("year"),
        F.when(gone, F.col("__month")).otherwise(F.col("month")).alias("month"),
        gone.alias("gone"),
    )


def to_read(listed: DataFrame, changed: DataFrame, unit: Unit) -> DataFrame:
    """Paths of the listed files that a load of the changes has to read."""
    if unit == "file":
        return listed.join(changed.where("NOT gone").select("path"), "path", "left_semi").select("path")
    months = changed.where("year IS NOT NULL AND month IS NOT NULL").select("year", "month").distinct()
    undated = changed.where("NOT gone AND (year IS NULL OR month IS NULL)").select("path")
    of_months = listed.join(months, ["year", "month"], "left_semi").select("path")
    return of_months.union(listed.join(undated, "path", "left_semi").select("path"))
