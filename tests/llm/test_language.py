from __future__ import annotations

import random
from collections import Counter

import pytest
from pyspark.sql import functions as F

from sedimenta.llm import language as L
from sedimenta.llm import queries
from tests.llm.cases import dicts, empty_documents, odd_documents

SF_DIR = "/root/testdata/sf0.01"
SYLLABLES = {"aa": ["ka", "lo", "mi"], "bb": ["str", "eng", "ich"], "cc": ["ção", "ñ", "que"]}


def grams(text: str) -> Counter:
    words = "".join(c if c.isalpha() else " " for c in text.lower()).split()
    found: Counter = Counter()
    for word in words:
        padded = f" {word} "
        found.update(padded[i : i + k] for k in (1, 2, 3) for i in range(len(padded) - k + 1))
    del found[" "]
    return found


def ranking(counts: Counter, most: int) -> list[str]:
    return sorted(counts, key=lambda g: (-counts[g], len(g), g))[:most]


def brute(text: str | None, profiles: dict[str, list[str]], most: int) -> tuple[str, float]:
    own = ranking(grams(text or ""), most)
    if not own or not profiles:
        return "und", 0.0
    away = {}
    for lang, profile in profiles.items():
        place = {g: i for i, g in enumerate(profile)}
        away[lang] = sum(abs(i - place[g]) if g in place else most for i, g in enumerate(own))
    best = min(away, key=lambda lang: (away[lang], lang))
    rest = [d for lang, d in away.items() if lang != best]
    next_ = min(rest) if rest else most * len(own)
    return best, 1 - away[best] / next_ if next_ else 0.0


def random_rows(seed: int) -> list[tuple[int, str | None, str | None]]:
    rng = random.Random(seed)
    rows: list[tuple[int, str | None, str | None]] = []
    for i in range(90):
        lang = rng.choice(list(SYLLABLES))
        word = lambda: "".join(rng.choice(SYLLABLES[lang]) for _ in range(rng.randrange(1, 4)))  # noqa: B023, E731
        text = "".join(word().title() + rng.choice([" ", ", ", "1", "\n"]) for _ in range(rng.randrange(0, 30)))
        rows.append((i, text, lang if rng.random() < 0.9 else None))
    return rows + [(100, None, "aa"), (101, "", "bb"), (102, "123 !?", "cc"), (103, "漢字 ÀÉ ß İ", None), (104, "x", "aa")]


@pytest.mark.parametrize("most", [5, 40, 400])
def test_equals_brute_force(spark, most):
    rows = random_rows(most)
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string").repartition(3)
    params = L.Profiles(ranks=most, chunk=200)
    fitted = L.fit(docs, F.col("doc_id") % 3 > 0, params)
    counts: dict[str, Counter] = {}
    for i, text, lang in rows:
        if lang and text and i % 3 and grams(text):
            counts.setdefault(lang, Counter()).update(grams(text))
    profiles = {lang: ranking(c, most) for lang, c in counts.items()}
    number = lambda g: sum(ord(c) << 21 * i for i, c in enumerate(reversed(g)))
    want = {(lang, i, number(g)) for lang, p in profiles.items() for i, g in enumerate(p, 1)}
    assert {tuple(r) for r in fitted.collect()} == want
    for row in dicts(L.identify(docs, fitted, params)):
        assert (row["lang_pred"], row["score"]) == brute(row["text"], profiles, most)


def test_odd_rows_and_clashing_names(spark):
    docs = odd_documents(spark).withColumn("LANG_PRED", F.lit("old")).withColumn("lang", F.col("source"))
    fitted = L.fit(docs, F.lit(True))
    found = dicts(L.identify(docs, fitted))
    assert len(found) == docs.count()
    assert set(found[0]) == {*docs.columns, "lang_pred", "score"} - {"LANG_PRED"}
    answers: dict = {}
    for row in found:
        assert 0 <= row["score"] <= 1
        assert answers.setdefault(row["text"], row["lang_pred"]) == row["lang_pred"]
        assert (row["lang_pred"] == "und") == (not any(c.isalpha() for c in row["text"] or ""))


def test_without_anything_learned(spark):
    docs = odd_documents(spark).withColumn("lang", F.lit(None).cast("string"))
    found = dicts(L.identify(docs, L.fit(docs, F.lit(True))))
    assert {(r["lang_pred"], r["score"]) for r in found} == {("und", 0.0)}
    assert L.identify(empty_documents(spark), L.fit(docs, F.lit(True))).collect() == []


def test_more_languages_than_a_task_may_hold_are_refused(spark):
    docs = spark.createDataFrame([("x", "a"), ("y", "b")], "text string, lang string")
    with pytest.raises(ValueError, match="2 languages"):
        L.identify(docs, L.fit(docs, F.lit(True)), L.Profiles(languages=1))


def test_held_out_documents_are_identified(spark):
    """0.99 of the documents that no profile was learned from."""
    found = queries.op13_language(spark, SF_DIR).where("held_out")
    truth = queries.table(spark, SF_DIR, "documents").select(F.col("doc_id").alias("id"), "lang")
    right = found.join(truth, F.col("doc_id") == F.col("id")).select(F.avg((F.col("lang") == F.col("lang_pred")).cast("int")))
    assert right.first()[0] >= 0.99
