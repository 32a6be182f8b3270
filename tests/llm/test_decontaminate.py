from __future__ import annotations

import random
import re

import pytest

from sedimenta.llm.decontaminate import ItemAutomaton, Limits, cut, decontaminate, normal_words, without
from tests.llm.cases import dicts, empty_documents, odd_documents


def words(text):
    lowered = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", lowered)


def brute(text, items, window):
    w, hit, found = words(text), set(), set()
    for name, body in items:
        b = words(body)
        m = min(window, len(b))
        for k in range(len(b) - m + 1 if m else 0):
            for i in range(len(w) - m + 1):
                if w[i : i + m] == b[k : k + m]:
                    hit |= set(range(i, i + m))
                    found.add(str(name))
    return len(w), hit, sorted(found)


@pytest.mark.parametrize("seed", range(150))
def test_automaton_equals_brute_force(seed):
    rng = random.Random(seed)
    letters = "abcd"[: rng.randrange(2, 5)]
    make = lambda n: " ".join(rng.choice(letters) for _ in range(n))
    items = [(i, make(rng.randrange(0, 12))) for i in range(rng.randrange(0, 7))]
    window = rng.randrange(1, 6)
    automaton = ItemAutomaton([(str(i), normal_words(t)) for i, t in items], window)
    for _ in range(5):
        text = make(rng.randrange(0, 40))
        spans, found = automaton.read(normal_words(text))
        n, hit, names = brute(text, items, window)
        assert {p for a, b in spans for p in range(a, b + 1)} == hit
        assert sorted(found) == names
        assert all(a2 > b1 + 1 for (_, b1), (a2, _) in zip(spans, spans[1:], strict=False))


def test_words_are_those_of_the_pattern():
    text = "Héllo, WORLD-wide_web 12:30 Ä x {y}~z\x7fq 漢字!"
    assert [w.decode() for w in normal_words(text)] == words(text)
    assert normal_words(None) == []


@pytest.mark.parametrize("block_words", [5, 10_000])
def test_rows_equal_brute_force(spark, block_words):
    docs = odd_documents(spark)
    texts = [r["text"] for r in dicts(docs) if r["text"]]
    items = [(1, texts[0][:60]), (2, texts[5]), (3, "two words"), (4, None), (5, ""), (None, "no id here"), (2, "single")]
    table = spark.createDataFrame(items, "item_id long, text string")
    limits = Limits(window=4, share=5, block_words=block_words)
    got = dicts(decontaminate(docs, table, limits))
    assert len(got) == docs.count()
    named = [("" if i is None else i, t) for i, t in items]
    for r in got:
        n, hit, names = brute(r["text"], named, 4)
        assert (r["n_words"], r["n_hit"], r["items"]) == (n, len(hit), names)
        assert r["contaminated"] == (len(hit) > 0 and 5 * len(hit) >= n)
    clean = dicts(cut(decontaminate(docs, table, limits)))
    for r in clean:
        n, hit, _ = brute(r["text"], named, 4)
        assert words(r["clean_text"]) == [w for i, w in enumerate(words(r["text"])) if i not in hit]


def test_no_items_and_no_documents(spark):
    none = spark.createDataFrame([], "item_id long, text string")
    assert all(r["n_hit"] == 0 and not r["contaminated"] for r in dicts(decontaminate(odd_documents(spark), none)))
    assert dicts(decontaminate(empty_documents(spark), none)) == []


def test_cut_keeps_the_rest_as_it_was():
    assert without("One, two; THREE four.", [[1, 2]]) == "One,  four."
