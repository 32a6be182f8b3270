"""Input columns that are named like an operator's own, in any letter case: replaced, or kept as they are."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from sedimenta.llm import decontaminate, fim, importance, language, mixing, neardup, quality, secrets, sharding, spans
from tests.llm.cases import labels, odd_documents


def _quality(docs):
    rules = quality.QualityRules()
    return quality.quality_rules(docs, quality.fit(docs, labels(docs.sparkSession), rules), rules)


def _importance(docs):
    params = importance.Resampling()
    return importance.resample(docs, importance.fit(docs, labels(docs.sparkSession), params), params)


def _decontaminate(docs):
    items = docs.sparkSession.createDataFrame([("i", "a b c d e")], "item_id string, text string")
    return decontaminate.decontaminate(docs, items)


OPERATORS = {
    "quality": (_quality, ["N_WORDS", "Kept", "BASE_failed"]),
    "decontaminate": (_decontaminate, ["SPANS", "Items", "N_hit"]),
    "spans": (spans.remove_repeated_spans, []),
    "sharding": (sharding.random_shards, ["SHARD", "Slot"]),
    "mixing": (lambda docs: mixing.mix(docs, mixing.word_count(F.col("text"))), ["SIZE", "Target", "TAKEN"]),
    "importance": (_importance, ["KEPT", "Log_Weight"]),
    "secrets": (secrets.secret_spans, ["HEX", "Access"]),
    "neardup": (lambda docs: neardup.near_duplicates(docs, neardup.NearDuplicates()), ["KEPT", "Component_ID"]),
    "fim": (fim.fill_in_middle, ["FORM", "N", "Output"]),
    "language": (lambda docs: language.identify(docs, language.fit(docs.withColumn("lang", F.lit("x")), F.lit(True))), ["LANG_pred", "Score"]),
}

#: Names that helpers use inside.
INNER = ["__size", "__copy", "__part", "row", "r", "words", "spans", "key", "n", "draws", "answers", "bits", "col", "pos"]


@pytest.mark.parametrize("name", list(OPERATORS))
def test_clashing_names(spark, tmp_path, name):
    operator, outputs = OPERATORS[name]
    docs = odd_documents(spark).select("doc_id", "text", "source")
    docs = docs.select("*", *[F.lit(f"old {c}").alias(c) for c in outputs + INNER if c.lower() not in {o.lower() for o in outputs} or c in outputs])
    made = operator(docs)
    made.write.parquet(str(tmp_path / "out"))
    back = spark.read.parquet(str(tmp_path / "out"))
    lower = [c.lower() for c in made.columns]
    assert len(set(lower)) == len(lower) and set(map(str.lower, docs.columns)) <= set(lower)
    assert back.count() == docs.count()
    for c in outputs:
        assert back.where(F.col(c).cast("string") == f"old {c}").isEmpty()
    own = set(operator(odd_documents(spark).select("doc_id", "text", "source")).columns)
    for c in INNER:
        if c not in own and c in docs.columns:
            assert back.where(F.col(f"`{c}`") != f"old {c}").isEmpty()


def test_repeated_rows_keep_columns_named_like_the_helpers(spark):
    docs = odd_documents(spark).select("doc_id", "text", "source", F.lit("a").alias("__size"), F.lit("b").alias("__copy"), F.lit("c").alias("copy"), F.lit("d").alias("row"))
    mixed = mixing.mix(docs, mixing.word_count(F.col("text")))
    assert mixed.select("__size", "__copy").distinct().collect() == [("a", "b")]
    again = mixing.repeated(mixed, docs.columns)
    assert again.columns == docs.columns
    assert again.select("__size", "__copy", "copy", "row").distinct().collect() == [("a", "b", "c", "d")]
