from __future__ import annotations

import random

import pytest

from sedimenta.llm.chat import Budget, chat_windows, read_back
from tests.llm.cases import dicts

SCHEMA = "conv_id long, turn long, role string, text string, window string, place int, system string"


def conversations():
    rng = random.Random(5)
    odd = ["", None, "<turn user>\n", "</turn>\n", "&lt; &amp; & <", "a\\b\n\n", r"\### Assistant: </turn> ok", "é😀 漢", ">"]
    rows = []
    for c in range(25):
        n = rng.randrange(1, 12)
        for t in range(n):
            role = "system" if t == 0 and c % 3 == 0 else ("user", "assistant")[t % 2]
            text = " ".join(f"w{i}" for i in range(rng.randrange(0, 30)))
            rows.append((c, t, role, rng.choice([*odd, text, text, text]), "x", 1, "s"))
    rows += [(100, t, "assistant" if t % 2 else "user", f"turn {t} " + "x " * (t % 7), None, None, None) for t in range(400)]
    rows += [(101, 0, "user", "long " * 20_000, "", 0, ""), (101, 1, "assistant", "short", "", 0, "")]
    rows += [(None, 0, "user", "no id", "", 0, ""), (None, 1, "assistant", "still none", "", 0, "")]
    rows += [(102, None, "user", "null turn", "", 0, ""), (102, 1, None, "null role", "", 0, ""), (102, 1, "a>b&<\n", "role", "", 0, "")]
    rows += [(103, 0, "user", "same", "", 0, "")] * 3 + [(103, 0, "assistant", "same", "", 0, "")] * 2
    rows += [(104, 0, "system", "only system", "", 0, "")]
    return rows


def order(row):
    return (row[1] is not None, row[1] or 0, row[2] or "", row[3] or "")


@pytest.mark.parametrize("budget", [Budget(), Budget(stride=20, history=10), Budget(stride=7, history=7), Budget(stride=30, history=0)])
def test_windows_read_back_as_the_conversations(spark, budget):
    rows = conversations()
    turns = spark.createDataFrame(rows, SCHEMA).repartition(5)
    windows = dicts(chat_windows(turns, budget))
    read = {r["conv_id"]: r for r in dicts(read_back(chat_windows(turns, budget)))}
    for c in {r[0] for r in rows}:
        own = sorted((r for r in rows if r[0] == c), key=order)
        mine = sorted((w for w in windows if w["conv_id"] == c), key=lambda w: w["window"])
        said = "".join((r[2] or "") + "\n" + (r[3] or "") + "\n" for r in own)
        assert (read[c]["n_turns"], read[c]["turns_text"]) == (len(own), said)
        assert read[c]["loss_text"] == "".join(r[3] or "" for r in own if r[2] == "assistant")
        assert read[c]["formatted_chars"] == sum(len(w["formatted"]) for w in mine)
        for w in mine:
            assert w["formatted"].count("<turn ") == w["formatted"].count("</turn>\n") == w["turns"]
            if own[0][2] == "system":
                assert w["formatted"].startswith("<turn system>\n")
            size = lambda t: len((t or "").split()) + 2
            system = size(own[0][3]) if own[0][2] == "system" else 0
            if w["tokens"] > system + budget.history + budget.stride:
                said = [t.partition(">\n")[2] for t in w["formatted"].split("</turn>\n")[w["repeated"] : -1]]
                news = [t for i, t in enumerate(said) if system == 0 or w["repeated"] or i]
                assert len(news) == 1 and size(news[0]) > budget.stride


def test_history_is_repeated_and_not_learnt_twice(spark):
    rows = [(1, t, "assistant" if t % 2 else "user", f"a{t} b c", "", 0, "") for t in range(10)]
    windows = sorted(dicts(chat_windows(spark.createDataFrame(rows, SCHEMA), Budget(stride=20, history=10))), key=lambda w: w["window"])
    assert [w["repeated"] for w in windows] == [0, 2, 2]
    assert [w["turns"] for w in windows] == [4, 6, 4]


def test_turns_that_fit_alone_never_exceed_the_budget(spark):
    """Turns of almost a stride, which begin just before its end."""
    rows = [(c, t, "assistant" if t % 2 else "user", " ".join(["w"] * n), "", 0, "") for c, n in ((1, 500), (2, 509), (3, 510)) for t in range(8)]
    rows += [(4, t, "user", " ".join(["w"] * (1 + 97 * t % 510)), "", 0, "") for t in range(300)]
    windows = dicts(chat_windows(spark.createDataFrame(rows, SCHEMA)))
    assert max(w["tokens"] for w in windows) <= 512 + 128
    assert sum(w["turns"] - w["repeated"] for w in windows) == len(rows)


def test_empty_table(spark):
    none = spark.createDataFrame([], SCHEMA)
    assert dicts(chat_windows(none)) == [] and dicts(read_back(chat_windows(none))) == []


def test_no_python_in_the_plan(spark):
    plan = read_back(chat_windows(spark.createDataFrame(conversations(), SCHEMA).repartition(2)))
    assert "ArrowPython" not in plan._jdf.queryExecution().toString() and "PythonUDF" not in plan._jdf.queryExecution().toString()
