"""Documents with all the odd cases, and shared helpers."""

from __future__ import annotations

import random

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

SCHEMA = "doc_id long, text string, source string, words string, r string, row long, n_words string, spans string, key string"


def sentence(rng: random.Random, n: int) -> str:
    return " ".join(f"w{rng.randrange(40)}" for _ in range(n)) + "."


def odd_texts() -> list[str | None]:
    rng = random.Random(3)
    plain = [" ".join(sentence(rng, rng.randrange(3, 12)) for _ in range(8)) for _ in range(12)]
    long = " ".join(sentence(rng, 10) for _ in range(2000))
    same = "a b c d e " * 30
    return [
        *plain,
        plain[0],
        plain[0],
        plain[1] + " one more word",
        None,
        "",
        " \t\n\x0b\f\r ",
        "single",
        "two words",
        "héllo ünïcode çà 漢字 😀 Ä A",
        "line one\nline one\n\nline two\nline one\n",
        same,
        long,
        long + " tail",
        "### $$$ %% && ** || <<>>",
    ]


def odd_documents(spark: SparkSession) -> DataFrame:
    texts = odd_texts()
    rows = [(i, t, f"s{i % 4}" if i % 5 else None, "x", "y", 7, "z", "q", "k") for i, t in enumerate(texts)]
    rows += [rows[2], rows[2], (None, "no id here", "s1", *[None] * 6), (None, None, None, *[None] * 6)]
    return spark.createDataFrame(rows, SCHEMA).repartition(3)


def empty_documents(spark: SparkSession) -> DataFrame:
    return odd_documents(spark).where(F.lit(False))


def dicts(df: DataFrame) -> list[dict]:
    return [r.asDict(recursive=True) for r in df.collect()]


def labels(spark: SparkSession) -> DataFrame:
    rows = [(i, i % 3 and 1, 0) for i in range(20)] + [(None, 1, 0), (3, None, None), (4, 1, 1)]
    return spark.createDataFrame(rows, "doc_id long, quality int, toxic int")
