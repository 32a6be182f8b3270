from __future__ import annotations

import numpy as np
import pytest
from pyspark.sql import functions as F

from sedimenta.llm.mixing import Mixture, mix, pivot, repeated, source_targets, word_count
from tests.llm.cases import dicts, empty_documents, odd_documents


def targets(sizes, mixture):
    """Share by weight, hold sources at their limits, share the excess again."""
    names = sorted((s for s in sizes if s is not None), key=lambda s: s.encode()) + [s for s in sizes if s is None]
    weight = {s: mixture.weights[i % len(mixture.weights)] for i, s in enumerate(names)}
    total, held = mixture.share * sum(sizes.values()), {}
    while True:
        free = [s for s in names if s not in held]
        left = total - sum(held.values())
        now = {s: left * weight[s] / sum(weight[x] for x in free) for s in free}
        over = [s for s in free if now[s] > mixture.most * sizes[s]]
        if not over:
            return held | now
        held |= {s: mixture.most * sizes[s] for s in over}


@pytest.mark.parametrize("sizes", [{"a": 10, "b": 1000, "c": 5, None: 70}, {"a": 3}, {"z": 0, "é": 8, "Z": 1, "a": 1, "b": 2}, {"a": 0, "b": 0}, {"a": 9, "b": 3, "c": 6, "d": 9, "e": 1}, {f"s{i}": i * i for i in range(30)}])
def test_targets_equal_repeated_sharing(spark, sizes):
    table = spark.createDataFrame(list(sizes.items()), "source string, source_size long")
    got = {r["source"]: r["target"] for r in dicts(source_targets(table, Mixture()))}
    want = targets(sizes, Mixture())
    assert got.keys() == want.keys() and all(abs(got[s] - want[s]) < 1e-6 for s in want)


def test_pivot_keeps_words_and_expectations():
    rng = np.random.default_rng(0)
    sizes = np.array([5, 1, 9, 3, 3, 100, 2, 0, 7], float)
    shares = np.array([0.5, 0.25, 0.9, 0.01, 0.3, 0.5, 1.0, 0.5, 0.0])
    runs = np.array([pivot(sizes, shares, rng) for _ in range(6000)])
    assert np.allclose(runs @ sizes, shares @ sizes)
    assert (((runs > 0) & (runs < 1)).sum(1) <= 1).all()
    assert np.abs(runs.mean(0) - shares).max() < 0.03


@pytest.mark.parametrize("mixture", [Mixture(), Mixture(block=3, fan=2), Mixture(share=0.4, block=2, fan=3)])
def test_taken_words_come_near_the_target(spark, mixture):
    docs = odd_documents(spark)
    mixed = mix(docs, word_count(F.col("text")), mixture)
    got = dicts(mixed)
    assert len(got) == docs.count()
    by_source = {}
    for r in got:
        assert r["size"] == len((r["text"] or "").split())
        assert 0 <= r["copies"] <= mixture.most and r["taken"] == r["copies"] * r["size"]
        assert r["words"] in ("x", None) and r["key"] in ("k", None)
        by_source.setdefault(r["source"], []).append(r)
    want = targets({s: sum(r["size"] for r in rows) for s, rows in by_source.items()}, mixture)
    for s, rows in by_source.items():
        assert all(r["source_size"] == sum(x["size"] for x in rows) and abs(r["target"] - want[s]) < 1e-6 for r in rows)
        assert abs(sum(r["taken"] for r in rows) - want[s]) <= max(r["size"] for r in rows) + 1e-6
    out = dicts(repeated(mixed, docs.columns))
    assert len(out) == sum(r["copies"] for r in got)
    again = mix(docs.repartition(7), word_count(F.col("text")), mixture)
    key = lambda r: repr((r["doc_id"], r["text"], r["taken"]))
    assert sorted(map(key, got)) == sorted(map(key, dicts(again)))


def test_empty_table(spark):
    assert dicts(mix(empty_documents(spark), word_count(F.col("text")))) == []
