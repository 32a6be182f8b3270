from __future__ import annotations

from collections import Counter

import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from sedimenta.llm.queries import table
from tests.llm.cases import dicts, empty_documents, odd_documents
from tests.llm.test_decontaminate import brute as hits
from tests.llm.test_neardup import brute as groups

SF_DIR = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def stages(spark):
    """Rows before and after every stage."""
    docs, out = table(spark, SF_DIR, "documents"), {}
    for name, stage in corpus_pipeline.STAGES:
        before = dicts(docs)
        docs = stage(spark, docs, SF_DIR)
        after = dicts(docs)
        docs = spark.createDataFrame([tuple(r.values()) for r in after], docs.schema)
        out[name] = before, after
    return out


def test_columns(stages, spark):
    columns = table(spark, SF_DIR, "documents").columns
    *first, last = stages.values()
    assert all(list(after[0]) == columns for _, after in first)
    assert set(last[1][0]) == {*columns, "shard", "slot"}


def test_quality_keeps_good_labelled_documents(stages, spark):
    before, after = stages["quality rules"]
    good = {r["doc_id"] for r in dicts(table(spark, SF_DIR, "labels")) if r["quality"] == 1 and r["toxic"] == 0}
    long = {r["doc_id"] for r in before if len((r["text"] or "").split()) >= 50}
    kept = {r["doc_id"] for r in after}
    assert len(good & long & kept) >= 0.95 * len(good & long) and kept < {r["doc_id"] for r in before}


def test_one_of_each_near_duplicate_group(stages):
    before, after = stages["near duplicates"]
    rows = sorted(before, key=lambda r: r["doc_id"])
    from sedimenta.llm.neardup import NearDuplicates

    _, roots = groups([r["text"] for r in rows], NearDuplicates())
    assert {r["doc_id"] for r in after} == {rows[i]["doc_id"] for i in set(roots)}


def test_contaminated_documents_go(stages, spark):
    before, after = stages["benchmark decontamination"]
    items = [(r["item_id"], r["text"]) for r in dicts(table(spark, SF_DIR, "benchmark"))]
    kept = {r["doc_id"] for r in after}
    for r in before:
        n, hit, _ = hits(r["text"], items, 13)
        assert (r["doc_id"] in kept) == (not hit or 20 * len(hit) < n)


def test_mixture_and_shards(stages):
    before, after = stages["mixing to target weights"]
    size = lambda rows: sum(len((r["text"] or "").split()) for r in rows)
    longest = max(len((r["text"] or "").split()) for r in before)
    assert abs(size(after) - 1.5 * size(before)) <= 20 * longest
    before, after = stages["sharding"]
    assert len(after) == len(before)
    counts = [sum(r["shard"] == j for r in after) for j in range(24)]
    assert max(counts) - min(counts) <= 1


def test_empty_documents(spark):
    for _, stage in corpus_pipeline.STAGES:
        docs = empty_documents(spark)
        assert dicts(stage(spark, docs, SF_DIR)) == []


#: Names that operators use for columns of their own, and what stands in them here.
CLASHING = ["size", "SHARD", "n_words", "Kept", "spans", "row", "r", "words", "__copy", "given_3", "component_id", "taken", "key"]


@pytest.mark.parametrize("name", [name for name, _ in corpus_pipeline.STAGES])
def test_odd_rows_and_clashing_names(spark, name):
    """Columns come back as they were; a row comes back as often as its stage says."""
    stage = dict(corpus_pipeline.STAGES)[name]
    docs = odd_documents(spark).select("doc_id", *[F.concat(F.lit(f"{c} "), F.col("doc_id").cast("string")).alias(c) for c in CLASHING], "text", "source")
    given, kept = dicts(docs), dicts(stage(spark, docs, SF_DIR))
    columns = [c for c in docs.columns if name != "sharding" or c != "SHARD"]
    assert list(kept[0]) == columns + (["shard", "slot"] if name == "sharding" else [])
    count = lambda rows: Counter(repr([r[c] for c in columns]) for r in rows)
    before, after = count(given), count(kept)
    assert set(after) <= set(before)
    ids = {r["doc_id"] for r in kept}
    if name == "quality rules":
        assert all(len((r["text"] or "").split()) >= 50 for r in kept)
        assert all(after[k] in (0, n) for k, n in before.items())
    elif name == "near duplicates":
        assert max(after.values()) == 1 and {r["doc_id"] for r in given if not (r["text"] or "").split()} <= ids
    elif name == "benchmark decontamination":
        assert after == before
    elif name == "mixing to target weights":
        assert all(after[k] <= 2 * n for k, n in before.items())
    else:
        assert after == before
