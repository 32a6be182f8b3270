from __future__ import annotations

import math
import random
import re
from collections import Counter
from contextlib import contextmanager

import pytest
from pyspark.sql import functions as F

from sedimenta.llm import importance
from sedimenta.llm.importance import Resampling, fit, resample, top
from sedimenta.session import session_conf
from tests.llm.cases import dicts, empty_documents, labels, odd_documents


def corpus(spark):
    rng = random.Random(4)
    rows, lab = [], []
    for i in range(400):
        words = [f"w{rng.randrange(60)}" for _ in range(rng.randrange(20, 120))]
        bad = i % 4 == 0
        if bad:
            for _ in range(6):
                words[rng.randrange(len(words))] = f"bad{rng.randrange(4)}"
        rows.append((i, " ".join(words)))
        if i % 2 == 0 or i % 3 == 0:
            lab.append((i, 1, int(bad)))
    return spark.createDataFrame(rows, "doc_id long, text string"), spark.createDataFrame(lab, "doc_id long, quality int, toxic int")


def test_held_out_documents(spark):
    docs, lab = corpus(spark)
    labelled = {r["doc_id"] for r in dicts(lab)}
    got = [r for r in dicts(resample(docs, fit(docs, lab, Resampling()))) if r["doc_id"] not in labelled]
    good = [r["kept"] for r in got if r["doc_id"] % 4]
    bad = [r["kept"] for r in got if r["doc_id"] % 4 == 0]
    assert len(good) > 50 and sum(good) / len(good) > 0.95 and sum(bad) <= 0.2 * len(bad)


@pytest.mark.parametrize("part", [1, 2, 5])
def test_good_documents_without_a_label_stay_however_few_have_one(spark, part):
    """Long texts of mostly rare words; bad words are what tells, in either direction."""
    rng = random.Random(6)
    rows, lab = [], []
    for i in range(600):
        words = [f"w{int(rng.paretovariate(0.6))}" for _ in range(150)]
        if i % 4 == 0:
            for _ in range(30):
                words[rng.randrange(len(words))] = f"bad{rng.randrange(12)}"
        rows.append((i, " ".join(words)))
        if i % 4 and i % 3 and i % part == 0:
            lab.append((i, 1, 0))
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    known = spark.createDataFrame(lab, "doc_id long, quality int, toxic int")
    got = [r for r in dicts(resample(docs, fit(docs, known, Resampling()))) if r["doc_id"] not in {i for i, *_ in lab}]
    good = [r for r in got if r["doc_id"] % 4]
    bad = [r for r in got if r["doc_id"] % 4 == 0]
    assert sum(r["log_weight"] > -4 for r in good) > 0.9 * len(good) and sum(r["kept"] for r in good) > 0.85 * len(good)
    assert sum(r["log_weight"] > -4 for r in bad) < 0.2 * len(bad) and sum(r["kept"] for r in bad) < 0.4 * len(bad)


def brute(rows, trusted, pseudo):
    """log_weight of each row, and k, by hand; rows: (doc_id, text)."""
    grams = []
    for _, text in rows:
        words = re.findall(r"[^\x20\x09-\x0D]+", text or "")
        grams.append({(w,) for w in words} | set(zip(words, words[1:], strict=False)))
    own = [i in trusted for i, _ in rows]
    raw = Counter(g for of in grams for g in of)
    target = Counter(g for of, is_trusted in zip(grams, own, strict=True) if is_trusted for g in of)
    share = sum(target.values()) / sum(raw.values()) if raw else 0

    def weight(gram, is_trusted):
        t = target[gram] - is_trusted
        return round(math.log((t + pseudo) / (share * (raw[gram] - 1) + pseudo)) * 10_000)

    weights = [sum(weight(g, o) for g in of if raw[g] > 1) / 10_000 if share else 0 for of, o in zip(grams, own, strict=True)]
    return weights, round(sum(min(1.0, math.exp(w)) for w in weights))


@pytest.mark.parametrize("pseudo", [20.0, 0.5])
@pytest.mark.parametrize("odd", [True, False])
def test_equals_brute_force(spark, odd, pseudo):
    """Weights, the number drawn, and the rows drawn: those with the largest keys."""
    docs, lab = (odd_documents(spark), labels(spark)) if odd else corpus(spark)
    params = Resampling(pseudo=pseudo)
    got = dicts(resample(docs, fit(docs, lab, params), params))
    good = {}
    for r in dicts(lab):
        good[r["doc_id"]] = good.get(r["doc_id"], True) and r["quality"] == 1 and r["toxic"] == 0
    trusted = {i for i, fine in good.items() if fine and i is not None}
    weights, k = brute([(r["doc_id"], r["text"]) for r in got], trusted, pseudo)
    # Logarithms of two runtimes may round a half apart.
    assert all(abs(r["log_weight"] - w) <= 1e-4 * max(1, r["n_grams"]) for r, w in zip(got, weights, strict=True))
    assert sum(abs(r["log_weight"] - w) < 1e-9 for r, w in zip(got, weights, strict=True)) > 0.9 * len(got)
    assert sum(r["kept"] for r in got) == k
    drawn = sorted(got, key=lambda r: -r["key"])
    assert {r["key"] for r in got if r["kept"]} == {r["key"] for r in drawn[:k]}
    assert any(w > 0 for w in weights) and any(w < 0 for w in weights)


def test_hot_grams_are_dealt_over_parts(spark):
    docs, lab = corpus(spark)
    model = fit(docs, lab, Resampling())
    hot = model.counts.where(model.hot).count()
    assert 0 < hot < 10_000
    weights = importance.spread_weights(model, Resampling())
    assert weights.count() == model.counts.count() + hot * (importance.PARTS - 1)
    entries = docs.select(F.col("doc_id").alias("row"), F.lit(False).alias("trusted"), F.explode(importance.distinct_grams(F.col("text"))).alias("gram"))
    dealt = importance.spread(entries, model)
    assert dealt.count() == entries.count()
    most = dealt.groupBy("gram", "part").count().agg(F.max("count")).first()[0]
    assert most <= 400 // importance.PARTS + 1


def test_evidence_for_the_target_counts(spark):
    """A word that only target documents have weighs for them, even with a large trusted share."""
    rows = [(i, f"same word {'fine' if i % 2 else 'other'}") for i in range(200)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    known = spark.createDataFrame([(i, 1, 0) for i in range(1, 200, 4)], "doc_id long, quality int, toxic int")
    got = {r["doc_id"]: r["log_weight"] for r in dicts(resample(docs, fit(docs, known, Resampling())))}
    assert got[3] > 0.4 and abs(got[3] - got[1]) < 0.1 and got[2] < -0.4


@pytest.mark.parametrize("ranked", [1, 20, 1000])
@pytest.mark.parametrize("k", [0, 1, 7, 50, 99, 100, 200])
def test_top_equals_sorting(spark, monkeypatch, k, ranked):
    monkeypatch.setattr(importance, "RANKED", ranked)
    rng = random.Random(k)
    rows = [(i, rng.choice([rng.gauss(0, 3), 1.0, -5e7, 5e7])) for i in range(100)]
    got = {r["row"] for r in dicts(top(spark.createDataFrame(rows, "row long, key double"), k))}
    assert got == {i for i, _ in sorted(rows, key=lambda x: (-x[1], x[0]))[:k]}


def test_draws_follow_the_weights(spark):
    """Among equal weights every document is drawn about as often; the number drawn is exact."""
    docs = spark.range(40).select(F.col("id").alias("doc_id"), F.lit("same words").alias("text"))
    none = labels(spark).limit(0)
    hits = 0
    for seed in range(12):
        got = dicts(resample(docs, fit(docs, none, Resampling()), Resampling(seed=seed), k=10))
        assert sum(r["kept"] for r in got) == 10
        hits += sum(r["kept"] for r in got if r["doc_id"] < 20)
    assert 40 <= hits <= 80


def test_odd_rows(spark):
    docs = odd_documents(spark)
    got = dicts(resample(docs, fit(docs, labels(spark), Resampling())))
    assert len(got) == docs.count()
    assert all(r["log_weight"] == 0 for r in got if not (r["text"] or "").strip())
    assert all(r["key"] is not None for r in got)
    none = empty_documents(spark)
    assert dicts(resample(none, fit(none, labels(spark), Resampling()))) == []


@pytest.mark.parametrize(("odd", "often"), [(True, 5e-6), (False, 1e-3), (False, 2.0)])
def test_drawn_in_slices_equals_fit_and_resample(spark, monkeypatch, odd, often):
    """Whether no n-gram, some or all are looked up, and whatever batch the rows of one end in."""
    monkeypatch.setattr(importance, "OFTEN", often)
    monkeypatch.setattr(importance, "DRAWN", 2)
    docs, lab = (odd_documents(spark), labels(spark)) if odd else corpus(spark)
    params = Resampling(pseudo=0.5)
    wanted = resample(docs, fit(docs, lab, params), params)
    with session_conf(spark, {"spark.sql.execution.arrow.maxRecordsPerBatch": "7"}):
        got = importance.draw(docs, lab, params).collect()
        bare = importance.draw(docs, lab, params, with_text=False)
        assert bare.columns == wanted.drop("text").columns and bare.count() == len(got)
    assert got and sorted(map(repr, got)) == sorted(map(repr, wanted.collect()))


def test_drawing_without_rows_or_trusted_documents(spark):
    docs, _ = corpus(spark)
    none = labels(spark).limit(0)
    assert {r["log_weight"] for r in dicts(importance.draw(docs, none, k=10))} == {0.0}
    empty = empty_documents(spark)
    assert dicts(importance.draw(empty, labels(spark))) == []


def test_no_whole_shuffle_of_ngrams(spark, monkeypatch):
    """Slices are written one after the other, and no text is."""
    labelled, seen = importance.scratch, []

    @contextmanager
    def watched(session):
        with labelled(session) as kept:
            yield lambda df, label, **options: seen.append((label, df.columns)) or kept(df, label, **options)

    monkeypatch.setattr(importance, "scratch", watched)
    monkeypatch.setattr(importance, "DRAWN", 3)
    docs, lab = corpus(spark)
    importance.draw(docs, lab, with_text=False).collect()
    assert [label for label, _ in seen].count("sums") == importance.DRAWN + 1
    assert [columns for label, columns in seen if label == "numbered"] == [["row", "r", "noise", "trusted", "hashes", "firsts", "n"]]
