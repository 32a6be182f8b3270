from __future__ import annotations

import random
import time

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from sedimenta.llm.rows import CLEANED, written
from sedimenta.llm.spans import (
    SentenceSpans,
    least_runs,
    lists,
    remove_repeated_spans,
    sentences,
    span_hashes,
    spans_of,
    window_places,
    word_values,
)
from tests.llm.cases import dicts, empty_documents, odd_documents, odd_texts, sentence


def brute_spans(counts, p):
    out = set()
    for i in range(len(counts)):
        if counts[i] >= 2 * p.words:
            out.add((i, i))
            continue
        for j in range(i + p.sentences - 1, len(counts)):
            if sum(counts[i : j + 1]) >= p.words:
                out.add((i, j))
                break
        for j in range(i - p.sentences + 1, -1, -1):
            if sum(counts[j : i + 1]) >= p.words:
                out.add((j, i))
                break
    return out


def brute(rows, p):
    """Rows (id, text) in order of places; returns the removed sentences of each."""
    seen, removed = {}, []
    order = sorted(range(len(rows)), key=lambda i: (rows[i][0] is None, rows[i][0] or 0, i))
    found = {}
    for i in order:
        parts = [tuple((rows[i][1])[a:b].split()) for a, b in sentences(rows[i][1])]
        found[i] = [(a, b, tuple(parts[a : b + 1])) for a, b in sorted(brute_spans([len(x) for x in parts], p))]
        for a, b, words in found[i]:
            seen.setdefault(words, (i, a))
    for i in range(len(rows)):
        gone = {s for a, b, words in found[i] if seen[words] != (i, a) for s in range(a, b + 1)}
        removed.append(sorted(gone))
    return removed


@pytest.mark.parametrize("text", [t for t in odd_texts() if t] + ["A. B! C?\nD", "no stop", "\n\n", "x.y z... w", 'He said "yes." Then.\n\nNew'])
def test_sentences_are_the_whole_text(text):
    parts = sentences(text)
    assert "".join(text[a:b] for a, b in parts) == text
    assert all(a < b for a, b in parts)


def test_sentence_ends():
    text = 'One two. "Three four!" Five\nsix v1.2 seven? Eight'
    assert [text[a:b].strip() for a, b in sentences(text)] == ["One two.", '"Three four!"', "Five", "six v1.2 seven?", "Eight"]


@pytest.mark.parametrize("seed", range(60))
def test_spans_equal_brute_force(seed):
    rng = random.Random(seed)
    counts = np.array([rng.randrange(0, 15) for _ in range(rng.randrange(0, 20))], np.int64)
    p = SentenceSpans(words=rng.randrange(1, 20), sentences=rng.randrange(1, 4))
    got = spans_of(counts, p)
    assert {tuple(x) for x in got.tolist()} == brute_spans(counts.tolist(), p) and len(got) == len({tuple(x) for x in got.tolist()})


def test_hashes_agree_where_sentences_do():
    values = np.array([5, 7, 9, 5, 7, 9, 7, 5], np.uint64)
    spans = np.array([(i, j) for i in range(8) for j in range(i, 8)])
    by = {}
    for (i, j), h in zip(spans.tolist(), span_hashes(values, spans).tolist(), strict=True):
        assert by.setdefault(tuple(values[i : j + 1].tolist()), h) == h
    assert len(set(by.values())) == len(by)


def test_rows_equal_brute_force(spark):
    rng = random.Random(8)
    passage = " ".join(sentence(rng, 9) for _ in range(7))
    rows = []
    for i in range(60):
        parts = [sentence(rng, rng.randrange(2, 14)) for _ in range(rng.randrange(0, 12))]
        if rng.random() < 0.5:
            parts.insert(rng.randrange(len(parts) + 1), passage)
        rows.append((i, " ".join(parts)))
    p = SentenceSpans()
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    got = sorted(dicts(remove_repeated_spans(docs, p)), key=lambda r: r["doc_id"])
    assert [r["removed"] for r in got] == brute(rows, p)
    holders = [r for r, (_, t) in zip(got, rows, strict=True) if passage in t]
    assert sum(passage in r["text"] for r in holders) == 1
    for r, (_, text) in zip(got, rows, strict=True):
        parts = [text[a:b] for a, b in sentences(text)]
        assert r["text"] == "".join(s for i, s in enumerate(parts) if i not in r["removed"])
        assert r["n_removed_words"] == len(text.split()) - len(r["text"].split())


def plain(rng, n):
    return " ".join(f"v{rng.randrange(10**6)}" for _ in range(n))


@pytest.mark.parametrize("lengths", [[20, 20, 20], [30, 30], [60], [15, 1, 14, 1, 2, 25], [120], [5] * 12])
def test_passages_cut_at_both_ends_are_removed(spark, lengths):
    """However long its sentences, a passage glued to other text on both sides stays once only."""
    rng = random.Random(sum(lengths))
    passage = ". ".join(plain(rng, n) for n in lengths)
    rows = [(i, f"{plain(rng, 12)}. {plain(rng, 7)} {passage} {plain(rng, 9)}. {plain(rng, 11)}.") for i in range(6)]
    rows += [(9, f"{plain(rng, 60)}. {plain(rng, 70)}.")]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    got = sorted(dicts(remove_repeated_spans(docs)), key=lambda r: r["doc_id"])
    words = set(passage.split())
    left = [sum(w in words for w in r["text"].split()) for r in got]
    ends = 0 if min(lengths) > 5 or len(lengths) < 12 else 10  # next to whole sentences, cut ones stay
    assert left[0] == len(passage.split()) and max(left[1:]) <= ends and left[6] == 0
    for r, (_, text) in zip(got, rows, strict=True):
        assert set(text.split()) - words == set(r["text"].split()) - words
        assert r["n_removed_words"] == len(text.split()) - len(r["text"].split())


def test_text_that_repeats_its_own_words_keeps_one_window(spark):
    docs = spark.createDataFrame([(1, "a b c d e " * 30), (2, "x y z " * 5)], "doc_id long, text string")
    got = {r["doc_id"]: r["text"].split() for r in dicts(remove_repeated_spans(docs))}
    assert got[1] == list("abcde") * 10 and got[2] == list("xyz") * 5


def test_odd_rows(spark):
    docs = odd_documents(spark)
    got = dicts(remove_repeated_spans(docs))
    assert len(got) == docs.count()
    by_id = {}
    for r in got:
        by_id.setdefault(r["doc_id"], []).append(r)
    texts = odd_texts()
    assert by_id[0][0]["text"] == texts[0] and by_id[12][0]["text"] == ""
    assert by_id[15][0]["text"] is None and by_id[16][0]["text"] == ""
    assert sorted(len(r["text"]) for r in by_id[2])[:2] == [0, 0] and len(by_id[2]) == 3
    assert all(r["r"] in ("y", None) and r["key"] in ("k", None) for r in got)
    assert dicts(remove_repeated_spans(empty_documents(spark))) == []


def test_sentences_of_only_blanks_and_stops_split_as_described():
    text = 'a.b  c... "d?!" )\n\n e \t\x0b\n f.'
    assert [text[a:b] for a, b in sentences(text)] == ["a.b  c... ", '"d?!" ', ")\n\n ", "e \t\x0b\n ", "f."]


NONE = np.empty((0, 2), np.int64)


def test_lists_of_rows():
    column = pa.array([[{"a": 1, "b": 2}], None, [], [{"a": 3, "b": 4}, {"a": 5, "b": 6}]])
    assert [x.tolist() for x in lists(column)] == [[[1, 2]], [], [], [[3, 4], [5, 6]]]
    assert [x.tolist() for x in lists(column.slice(1))] == [[], [], [[3, 4], [5, 6]]]
    assert [x.tolist() for x in lists(pa.array([None, [1], [2, 3]], pa.list_(pa.int32())))] == [[], [1], [2, 3]]
    assert [x.tolist() for x in lists(column.slice(1, 1))] == [[]] and list(lists(column[:0])) == []


def test_windows_are_those_whose_least_run_repeats():
    """Only they can repeat: equal windows have their least run at the same place."""
    values = word_values([f"w{i}" for i in range(40)])
    hashes, least = least_runs(values, 5)
    assert len(hashes) == 36 and len(least) == 31
    assert least.tolist() == [i + int(hashes[i : i + 6].argmin()) for i in range(31)]
    run = min(least.tolist(), key=least.tolist().count)
    want = [i for i in range(31) if least[i] == run]
    assert window_places(least, 5, [run], NONE).tolist() == want and len(want) < 6
    assert window_places(least, 5, [run], np.array([(want[0], want[0] + 10)])).tolist() == want[1:]
    assert window_places(least, 5, [], NONE).tolist() == [] and least_runs(values[:9], 5)[1].tolist() == []


def test_word_values_tell_words_apart():
    words = ["a", "b", "ab", "ba", "é", "a", "ab" * 40, "\x00", "\x00\x00"]
    got = word_values(words).tolist()
    assert len(got) == 9 and got[0] == got[5] and len(set(got)) == 8 and word_values([]).tolist() == []


def shuffle_files(spark):
    return str(spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllFiles()).count("shuffle_")


def test_tables_in_between_leave_no_shuffle_files(spark):
    """What is shuffled for a table goes once it is written, so that disk holds one step's shuffle at a time."""
    before = shuffle_files(spark)
    counted = written(spark.range(1000).repartition(5).groupBy((F.col("id") % 7).alias("k")).count(), "counted")
    deadline = time.monotonic() + 20
    while shuffle_files(spark) > before and time.monotonic() < deadline:
        time.sleep(0.1)
    assert shuffle_files(spark) <= before and counted.count() == 7
    assert all(spark.conf.get(key) == "false" for key in CLEANED)
