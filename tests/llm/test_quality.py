from __future__ import annotations

import math
import os
import re
from collections import Counter

import pytest
import xxhash

from sedimenta.llm import quality, rows
from sedimenta.llm.quality import SCALE, QualityRules
from tests.llm.cases import dicts, empty_documents, labels, odd_documents

RULES = QualityRules(bits=8, prior=5.0, least_mean=-0.05)


def words(text):
    return re.findall(r"[^\x20\x09-\x0D]+", text or "")


def base(text):
    w = words(text)
    lines = [x for x in (text or "").split("\n") if words(x)]
    triples = [tuple(w[i : i + 3]) for i in range(len(w) - 2)]
    often = Counter(triples)
    hit = {j for i, t in enumerate(triples) if often[t] > 1 for j in range(i, i + 3)}
    return {
        "n_words": len(w),
        "word_chars": sum(map(len, w)),
        "n_symbols": len(re.findall(r"[#*$%&|<>]", text or "")),
        "n_dup_lines": len(lines) - len(set(lines)),
        "n_repeat_words": len(hit),
        "base_failed": len(w) < 50 or 100 * len(hit) > 50 * len(w),
    }


def signed(x):
    return x - (1 << 64) if x >> 63 else x


def word_hash(w):
    return xxhash.xxh64_intdigest(w.encode(), 42)


def pair_hash(a, b):
    # Spark chains the columns: the hash so far seeds the next one.
    first = xxhash.xxh64_intdigest(a.to_bytes(8, "little"), 42)
    return xxhash.xxh64_intdigest(b.to_bytes(8, "little"), first)


def buckets(text, bits):
    h = [word_hash(w) for w in words(text)]
    return [x >> (64 - bits) for x in h + [pair_hash(a, b) for a, b in zip(h, h[1:], strict=False)]]


def test_counts_scores_and_verdicts_equal_brute_force(spark):
    docs, lab = odd_documents(spark), labels(spark)
    got = dicts(quality.quality_rules(docs, quality.fit(docs, lab, RULES), RULES))
    assert len(got) == docs.count()
    good = {r["doc_id"] for r in dicts(lab) if r["quality"] == 1 and r["toxic"] == 0} - {3, 4, None}
    raw, target = Counter(), Counter()
    for r in got:
        b = buckets(r["text"], RULES.bits)
        raw.update(b)
        if r["doc_id"] in good:
            target.update(b)
    share = target.total() / raw.total()
    weight = {
        b: round(math.log((target[b] + RULES.prior * share) / (share * (raw[b] + RULES.prior))) * SCALE)
        for b in range(1 << RULES.bits)
    }
    for r in got:
        want = base(r["text"])
        assert {k: r[k] for k in want if k != "n_words"} | {"n_words": int(r["n_words"])} == want
        grams = buckets(r["text"], RULES.bits)
        total = sum(weight[b] for b in grams)
        if not grams:
            assert r["mean_log_ratio"] is None and not r["kept"]
            continue
        assert abs(r["mean_log_ratio"] - total / len(grams) / SCALE) < 2e-4
        if abs(total / len(grams) - RULES.least_mean * SCALE) > 2:
            assert r["kept"] == (not want["base_failed"] and total >= RULES.least_mean * SCALE * len(grams))
        assert r["words"] in ("x", None) and r["r"] in ("y", None)


def test_every_word_of_a_large_corpus_has_its_own_ratio(spark):
    """A word of bad texts alone, one in 200, is told from the many others whatever their number."""
    rows = [(i, " ".join(f"w{60 * i + j}" for j in range(60)) + " spam" * (i % 200 == 0)) for i in range(4000)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    lab = spark.createDataFrame([(i, 1, 0) for i in range(1, 4000, 2)], "doc_id long, quality int, toxic int")
    rules = QualityRules(prior=2.0)
    words_of = spark.createDataFrame([(1, "spam"), (2, "w120"), (3, "w180 w181"), (4, "never")], "doc_id long, text string")
    got = {r["doc_id"]: r["mean_log_ratio"] for r in dicts(quality.quality_rules(words_of, quality.fit(docs, lab, rules), rules))}
    own = {n: math.log((n + 1) / (0.5 * 3)) for n in (0, 1)}
    assert abs(got[1] - math.log(1 / (0.5 * 22))) < 0.05 and abs(got[2] - own[0]) < 0.01
    assert abs(got[3] - own[1]) < 0.01 and got[4] == 0


def test_empty_table_and_no_labels(spark):
    docs, lab = odd_documents(spark), labels(spark)
    none = lab.limit(0)
    assert dicts(quality.quality_rules(empty_documents(spark), quality.fit(empty_documents(spark), lab, RULES), RULES)) == []
    assert all(not r["mean_log_ratio"] for r in dicts(quality.quality_rules(docs, quality.fit(docs, none, RULES), RULES)))


def test_no_python_in_the_plan(spark):
    docs = odd_documents(spark)
    plan = quality.quality_rules(docs, quality.fit(docs, labels(spark), RULES), RULES)._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan


def test_slices_shuffle_a_part_each_and_give_the_whole_counts(spark, monkeypatch):
    docs = odd_documents(spark)
    labelled = labels(spark)
    sizes = []
    kept = quality.written
    monkeypatch.setattr(quality, "written", lambda df, label, **o: (sizes.append((label, kept(df, label, **o))), sizes[-1][1])[1])
    rules = QualityRules()
    dicts(quality.quality_rules(docs, quality.fit(docs, labelled, rules), rules))
    slices = [df for label, df in sizes if label == "grams"]
    raw = Counter(b for r in dicts(docs) for b in map(signed, buckets(r["text"], 64)))
    got = [{r["bucket"]: r["raw"] for r in dicts(df)} for df in slices]
    assert len(slices) == quality.COUNTED > 1
    assert sum(map(len, got)) == len(raw) and {b: n for g in got for b, n in g.items()} == raw
    assert max(map(len, got)) < 0.75 * len(raw)


@pytest.mark.parametrize(
    ("rules", "often"), [(RULES, 0.01), (QualityRules(prior=5.0, least_mean=-0.05), 0.01), (QualityRules(prior=0.5), 2.0), (QualityRules(), quality.OFTEN)]
)
def test_fitted_documents_are_judged_in_one_exchange_as_in_two_steps(spark, monkeypatch, rules, often):
    """Whatever is taken as frequent, with or without trusted texts; scratch tables are emptied."""
    monkeypatch.setattr(quality, "OFTEN", often)
    monkeypatch.setattr(quality, "JUDGED", 2)
    docs = odd_documents(spark).coalesce(2)
    of = lambda found: sorted((tuple(r.items()) for r in dicts(found)), key=repr)
    known = labels(spark)
    two_steps = of(quality.quality_rules(docs, quality.fit(docs, known, rules), rules))
    assert of(quality.judge(docs, known, rules)) == two_steps


def test_judging_odd_tables(spark, monkeypatch):
    monkeypatch.setattr(quality, "JUDGED", 2)
    docs, none = odd_documents(spark), labels(spark).limit(0)
    without = quality.judge(docs, none, with_text=False)
    assert "text" not in without.columns and without.count() == docs.count()
    assert all(not r["mean_log_ratio"] for r in dicts(without))
    assert dicts(quality.judge(empty_documents(spark), labels(spark))) == []


def test_judging_keeps_no_ngrams_and_no_scratch_tables(spark, monkeypatch):
    tables = []
    keep = rows.written

    def noted(df, label, path=None, **options):
        made = keep(df, label, path, **options)
        tables.append((label, made, made.count()))
        return made

    monkeypatch.setattr(rows, "written", noted)
    docs = odd_documents(spark)
    found = quality.judge(docs, labels(spark))
    assert "Python" not in found._jdf.queryExecution().toString()
    sums = [(df, n) for label, df, n in tables if label == "sums"]
    assert len(sums) == quality.JUDGED + 1 and all(n <= docs.count() for _, n in sums)
    assert not any("grams" in label for label, *_ in tables)
    assert any(n for label, _, n in tables if label == "counted")
    assert not any(os.path.exists(f.removeprefix("file://")) for _, df, _ in tables for f in df.inputFiles())
