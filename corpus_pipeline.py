"""Documents through five stages: quality, near duplicates, contamination, mixture, shards.

Every stage takes whole documents with any other columns, whatever their names, and gives the kept
ones back with the values that they came with; no rows give none. Documents may have a null id, a
null or empty text or a null source, and rows may repeat; each stage says what becomes of them.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sedimenta.llm import decontaminate, mixing, neardup, quality, sharding
from sedimenta.llm.queries import table
from sedimenta.llm.rows import quoted
from sedimenta.session import shared_folder

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


#: Columns that the operators read. The others go through under names that no operator uses.
READ = ("doc_id", "text", "source")


def _names(docs: DataFrame) -> dict[str, str]:
    return {c: c if c in READ else f"given_{i}" for i, c in enumerate(docs.columns)}


def _carried(docs: DataFrame) -> DataFrame:
    return docs.select(*[quoted(c).alias(name) for c, name in _names(docs).items()])


def _as_given(judged: DataFrame, docs: DataFrame, *new: str) -> DataFrame:
    """The columns of ``docs`` again; one named like a ``new`` one makes room for it."""
    names = {c: name for c, name in _names(docs).items() if c.lower() not in new}
    return judged.select(*[quoted(name).alias(c) for c, name in names.items()], *new)


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality rules keep; the raw model counts the given ones.

    Null, empty and short texts go; repeated rows are kept or go together.
    """
    judged = quality.judge(_carried(docs), table(spark, sf_dir, "labels"))
    return _as_given(judged.where("kept"), docs)


def near_duplicate_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates: five-word shingles, similarity 0.8.

    The least id stays, one row of it; texts without a word are in no group and stay.
    """
    found = neardup.near_duplicates(_carried(docs), neardup.NearDuplicates())
    return _as_given(found.where("kept"), docs)


def decontamination_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents of which less than one word in twenty is in a window of a benchmark item.

    Null and empty texts stay; repeated rows stay or go together.
    """
    judged = decontaminate.decontaminate(_carried(docs), table(spark, sf_dir, "benchmark"))
    return _as_given(judged.where("NOT contaminated"), docs)


def mixing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mixture takes them, each row by itself.

    A null source is one of its own; texts without a word count nothing and are drawn like others.
    """
    given = _carried(docs)
    mixed = mixing.mix(given, mixing.word_count(F.col("text")))
    return _as_given(mixing.repeated(mixed, given.columns), docs)


def sharding_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with ``shard`` and ``slot``, their place in it; every row, repeated ones too."""
    return _as_given(sharding.random_shards(_carried(docs)), docs, "shard", "slot")


STAGES: list[tuple[str, Stage]] = [
    ("quality rules", quality_stage),
    ("near duplicates", near_duplicate_stage),
    ("benchmark decontamination", decontamination_stage),
    ("mixing to target weights", mixing_stage),
    ("sharding", sharding_stage),
]

#: Scores of hashed n-grams and random draws are not to be had in SQL.
ORACLE_SQL: str | None = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages, each written as Parquet and read again as the input of the next."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        path = shared_folder(spark, name.replace(" ", "-"))
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
