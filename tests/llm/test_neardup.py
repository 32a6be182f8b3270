from __future__ import annotations

import os
import random
import re
from itertools import combinations

import pytest
from pyspark.sql import functions as F

from sedimenta.llm import neardup, rows
from sedimenta.llm.components import components
from sedimenta.llm.neardup import NearDuplicates, near_duplicates
from tests.llm.cases import dicts, empty_documents, odd_documents


def shingles(text, width):
    lowered = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    w = re.findall(r"[^\x20\x09-\x0D]+", lowered)
    if not w:
        return set()
    m = min(width, len(w))
    return {tuple(w[i : i + m]) for i in range(len(w) - m + 1)}


def brute(texts, params):
    sets = [shingles(t, params.width) for t in texts]
    group = list(range(len(texts)))

    def root(x):
        while group[x] != x:
            x = group[x]
        return x

    for a, b in combinations(range(len(texts)), 2):
        if sets[a] and 100 * len(sets[a] & sets[b]) >= params.percent * len(sets[a] | sets[b]):
            x, y = root(a), root(b)
            group[max(x, y)] = min(x, y)
    return [len(s) for s in sets], [root(i) for i in range(len(texts))]


def copies(seed):
    """Families of near copies, some far from most of their family, and many unrelated texts."""
    rng = random.Random(seed)
    line = [f"common{i}" for i in range(40)]
    texts = []
    for f in range(5):
        first = [f"w{rng.randrange(500)}" for _ in range(rng.randrange(5, 200))]
        now = first
        for _ in range(rng.randrange(1, 25)):
            words = list(rng.choice([first, now]))
            for _ in range(rng.randrange(0, 1 + len(words) // 25)):
                words[rng.randrange(len(words))] = f"x{rng.randrange(10**6)}"
            now = words
            texts.append(" ".join(words))
    for _ in range(40):
        own = [f"u{rng.randrange(10**6)}" for _ in range(rng.randrange(1, 60))]
        texts.append(" ".join(own + (line if rng.random() < 0.5 else [])))
    rng.shuffle(texts)
    return texts


@pytest.mark.parametrize("params", [NearDuplicates(width=3, percent=85), NearDuplicates(), NearDuplicates(width=3, percent=85, stars=0)])
def test_groups_equal_brute_force(spark, params):
    texts = copies(params.percent)
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(4)
    got = {r["doc_id"]: r for r in dicts(near_duplicates(docs, params))}
    sizes, groups = brute(texts, params)
    assert [got[i]["n_shingles"] for i in range(len(texts))] == sizes
    assert [got[i]["component_id"] for i in range(len(texts))] == groups
    assert [got[i]["kept"] for i in range(len(texts))] == [g == i for i, g in enumerate(groups)]


def test_odd_rows(spark):
    docs = odd_documents(spark)
    params = NearDuplicates(width=3, percent=85)
    got = dicts(near_duplicates(docs, params))
    assert len(got) == docs.count()
    ids = [r["doc_id"] for r in got]
    order = sorted(range(len(got)), key=lambda i: (ids[i] is None, ids[i] or 0))
    sizes, groups = brute([got[i]["text"] for i in order], params)
    for place, i in enumerate(order):
        assert got[i]["n_shingles"] == sizes[place]
        assert got[i]["component_id"] == ids[order[groups[place]]]
    # One row of each group stays, also where rows are repeated.
    assert sum(r["kept"] for r in got) == len(set(groups))
    assert all(r["kept"] for r in got if not (r["text"] or "").strip())
    assert dicts(near_duplicates(empty_documents(spark), params)) == []


def test_small_sets_that_differ_in_one_shingle(spark):
    """Six of seven shingles are enough at 85 percent, four of five at 80."""
    for params, n in ((NearDuplicates(width=3, percent=85), 9), (NearDuplicates(width=3, percent=80), 7)):
        texts = []
        for f in range(60):
            words = [f"f{f}w{i}" for i in range(n)]
            texts += [" ".join(words), " ".join(words[:-1])]
        docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
        got = {r["doc_id"]: r["component_id"] for r in dicts(near_duplicates(docs, params))}
        assert all(got[2 * f + 1] == 2 * f == got[2 * f] for f in range(60))


def test_joined_path_equals_sent_path(spark, monkeypatch):
    monkeypatch.setattr(neardup, "MOST_SENT", 0)
    test_groups_equal_brute_force(spark, NearDuplicates(width=3, percent=85))


def test_components_of_a_long_chain_and_a_star(spark):
    chain = [(i, i + 1) for i in range(60)] + [(100, i) for i in range(101, 160)] + [(7, 7), (5, 4)]
    links = spark.createDataFrame(chain, "a long, b long").orderBy(F.rand(1))
    got = {r["node"]: r["component"] for r in dicts(components(links))}
    assert got == {i: 0 for i in range(61)} | {i: 100 for i in range(100, 160)}
    assert dicts(components(links.limit(0))) == []


def test_sketches_are_emptied_before_the_result_is_read(spark, monkeypatch):
    tables = []
    keep = rows.written

    def noted(df, label, path=None, **options):
        made = keep(df, label, path, **options)
        tables.append((label, made.count(), made.inputFiles()))
        return made

    monkeypatch.setattr(rows, "written", noted)
    docs = odd_documents(spark)
    found = near_duplicates(docs)
    assert found.count() == docs.count()
    files = [f for label, n, of in tables if label == "sketches" and n for f in of]
    assert files and not any(os.path.exists(f.removeprefix("file://")) for f in files)
