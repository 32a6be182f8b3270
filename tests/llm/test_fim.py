from __future__ import annotations

import hashlib
import random
import re

import pytest
from pyspark.sql import functions as F

from sedimenta.llm import fim, queries
from tests.llm.cases import dicts, empty_documents, odd_documents


def brute(doc_id: int | None, text: str | None, seed: int, plain: int, spm: int) -> dict:
    """One text by hand."""
    text = text or ""
    units = re.findall(r"[A-Za-z]+|[^A-Za-z]", text)
    digest = hashlib.sha256(f"{seed}:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    h1, h2, h3, h4 = (int(digest[i : i + 8], 16) for i in range(0, 32, 8))
    n = len(units)
    one, two = sorted((h1 % (n + 1), h2 % (n + 1)))
    p, m, s = ("".join(part) for part in (units[:one], units[one:two], units[two:]))
    if not text or re.search("<[PSM]>", text) or h3 % 100 >= 100 - plain:
        return {"n": n, "form": "plain", "prefix": None, "middle": None, "suffix": None, "output": text}
    form = "spm" if h4 % 100 < spm else "psm"
    output = f"<P>{p}<S>{s}<M>{m}" if form == "psm" else f"<S>{s}<P>{p}<M>{m}"
    return {"n": n, "form": form, "prefix": p, "middle": m, "suffix": s, "output": output}


MARKED = ["a <P> b", "<S>", "tail <M>", "<P", "<<S", "S> x <", "<p>", "<P><S><M>", "a<"]
STRANGE = ["\x00 \x00a", "é", "漢字 ab 漢", "😀😀", "é x", " \x85", " ", "\n", "A" * 5000, "1" * 5000]


@pytest.fixture(scope="module")
def documents(spark):
    rng = random.Random(8)
    more = ["".join(rng.choice("ab C.\n<é漢😀>PSM") for _ in range(rng.randrange(60))) for _ in range(300)]
    odd = odd_documents(spark)
    rows = [(1000 + i, t, "s", "w", "r", 5, "n", "sp", "k") for i, t in enumerate([*MARKED, *STRANGE, *more])]
    extra = spark.createDataFrame(rows, odd.schema)
    return odd.union(extra)


@pytest.mark.parametrize("params", [fim.FillInMiddle(), fim.FillInMiddle(0, 50, 7, 64), fim.FillInMiddle(50, 100, 2)])
def test_equals_brute_force(documents, params):
    made = dicts(fim.fill_in_middle(documents, params))
    assert len(made) == documents.count()
    for row in made:
        want = brute(row["doc_id"], row["text"], params.seed, params.plain_percent, params.spm_percent)
        assert {k: row[k] for k in want} == want
    assert {r["form"] for r in made} >= {"plain", "spm"}


def test_output_and_form_give_the_text_back(documents):
    made = fim.fill_in_middle(documents, fim.FillInMiddle(plain_percent=0))
    again = made.select(
        F.coalesce("text", F.lit("")).alias("text"), fim.restored(F.col("output"), F.col("form")).alias("again"), "form"
    )
    rows = again.collect()
    assert all(r["text"] == r["again"] for r in rows)
    assert sum(r["form"] != "plain" for r in rows) > 200


def test_no_rows(spark):
    assert fim.fill_in_middle(empty_documents(spark)).collect() == []


def test_columns_named_like_outputs_are_replaced_in_any_letter_case(spark):
    given = spark.createDataFrame([(1, "ab cd", "x", "y", 2)], "doc_id long, text string, N string, Form string, draws int")
    made = fim.fill_in_middle(given)
    assert made.columns == ["doc_id", "text", "draws", "n", "form", "prefix", "middle", "suffix", "output"]
    assert made.first()["n"] == 3


def test_long_text_is_cut_whole(spark):
    text = "word, " * 400_000
    (row,) = dicts(fim.fill_in_middle(spark.createDataFrame([(1, text), (2, "b")], "doc_id long, text string").where("doc_id = 1")))
    assert row["n"] == 1_200_000
    assert brute(1, text, 1, 10, 20)["output"] == row["output"]


def test_shares_of_forms(spark):
    ids = spark.range(20_000).select(F.col("id").alias("doc_id"), F.lit("a b c").alias("text"))
    counts = {r["form"]: r["count"] for r in fim.fill_in_middle(ids).groupBy("form").count().collect()}
    assert abs(counts["plain"] / 20_000 - 0.1) < 0.01
    assert abs(counts["spm"] / (20_000 - counts["plain"]) - 0.2) < 0.01


def test_query_reads_texts_back(spark):
    rows = dicts(queries.op11_fill_in_middle(spark, "/root/testdata/sf0.001"))
    texts = queries.table(spark, "/root/testdata/sf0.001", "documents").collect()
    digests = {r["doc_id"]: hashlib.sha256((r["text"] or "").encode()).hexdigest() for r in texts}
    assert {r["doc_id"]: r["restored_sha256"] for r in rows} == digests
