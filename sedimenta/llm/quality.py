"""Quality rules: base counts of each text and an n-gram log-likelihood ratio.

Two multinomials over hashed words and word pairs: one of trusted texts, one of the raw corpus. A
document's score is the mean logarithm of their ratio over its n-grams. Everything is built-in
column expressions; the model is a table of the corpus's n-grams, joined to the documents.

N-grams are shuffled one slice of their hashes after the other, so that a part of them is on disk at
a time. For scoring, the hashes of the words are kept, few distinct ones, and paired again for each.

``judge`` fits and scores the same documents: each occurrence of an n-gram is shuffled once, counted
where it arrives, and its weight goes back to its row. No table of n-grams is kept.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sedimenta.llm import words as W
from sedimenta.llm.rows import ROW, packed, scratch, unpacked, written


@dataclass(frozen=True)
class QualityRules:
    """Parameters.

    bits             n-grams are told apart by so many bits of their hash
    prior            raw occurrences added to every n-gram
    least_mean       a mean log ratio below this rejects, in nats for each n-gram
    least_words      fewer words fail
    most_repeated    more words than this share in repeated 3-word windows fail, in percent
    target_documents the trusted model is fitted on at most so many trusted documents
    """

    bits: int = 64
    prior: float = 50.0
    least_mean: float = -0.1
    least_words: int = 50
    most_repeated: int = 50
    target_documents: int = 20_000


#: An n-gram with more than this share of all occurrences is frequent: fewer than 10,000 are, ever.
FREQUENT = 1e-4
#: Slices of the n-grams, counted and scored one after the other.
COUNTED, SCORED = 2, 4
#: Slices of the occurrences where fitted documents are scored, told by the first word of an n-gram.
JUDGED = 12
#: N-grams with more than this share of the occurrences in one document of so many are looked up in a
#: broadcast table: fewer than 200,000, ever. Which ones are does not change what is counted.
OFTEN, PROBED = 5e-6, 16
#: Distinct word hashes of a file, so many bytes of them, are written once and then numbered.
NUMBERED = {"parquet.dictionary.page.size": str(8 << 20)}
SCALE = 10_000  # log ratios are whole ten-thousandths: sums do not depend on the order of rows


def trusted_ids(labels: DataFrame, most: int) -> DataFrame:
    """Ids of documents labelled good and not toxic; beyond ``most``, those with the least hash."""
    good = labels.where("doc_id IS NOT NULL").groupBy("doc_id").agg(
        F.min(F.coalesce((F.col("quality") == 1) & (F.col("toxic") == 0), F.lit(False))).alias("good")
    )
    chosen = good.where("good").select("doc_id").orderBy(F.xxhash64("doc_id"), "doc_id").limit(most)
    return chosen


def log_ratio(raw: Column, target: Column, share: Column, prior: float) -> Column:
    """The scaled log ratio of so many occurrences, ``share`` being that of target ones among all."""
    ratio = F.log((target + F.lit(prior) * share) / (share * (raw + F.lit(prior))))
    return F.round(ratio * SCALE).cast("long")


def log_ratios(counts: DataFrame, prior: float) -> DataFrame:
    """bucket, w and frequent: the scaled log ratio of target and raw of n-grams where it is not 0.

    ``counts``: bucket, raw and target occurrences. ``prior`` raw occurrences, and their share of
    target ones, smooth each bucket, so that of an n-gram not counted is 0. Without any trusted
    n-gram every ratio is 0.
    """
    totals = written(counts.agg(F.sum("raw").alias("raws"), F.sum("target").alias("targets")), "sums")
    share = F.try_divide(F.col("targets").cast("double"), F.col("raws"))
    weight = F.when(share > 0, log_ratio(F.col("raw"), F.col("target"), share, prior)).otherwise(F.lit(0).cast("long"))
    by_bucket = counts.join(F.broadcast(totals))  # one row
    return by_bucket.select(
        "bucket", weight.alias("w"), (F.col("raw") > FREQUENT * F.col("raws")).alias("frequent")
    ).where("w != 0")


def buckets(df: DataFrame, hashes: Column, bits: int, *kept: Column) -> DataFrame:
    """bucket, the upper ``bits`` of its hash, of every n-gram occurrence, after the columns ``kept``."""
    given = df.select(*kept, hashes.alias("hashes"))
    after = F.slice("hashes", F.lit(2), F.greatest(F.size("hashes") - 1, F.lit(0))).alias("after")
    pairs = given.select(*[c for c in given.columns if c != "hashes"], F.inline(F.arrays_zip(F.col("hashes").alias("word"), after)))
    *names, word, after = pairs.columns
    pair = F.when(F.col(after).isNotNull(), F.xxhash64(word, after))
    grams = pairs.select(*names, F.explode(F.array(F.col(word), pair)).alias("gram"))
    return grams.where("gram IS NOT NULL").select(*names, F.shiftrightunsigned("gram", 64 - bits).alias("bucket"))


def slices(n: int) -> list[Column]:
    """Conditions of which each bucket meets one."""
    return [F.pmod("bucket", F.lit(n)) == i for i in range(n)]


def gram_counts(docs: DataFrame, trusted: Column, bits: int, text: str = "text") -> DataFrame:
    """bucket, raw, target: n-gram occurrences in all texts and in those where ``trusted`` holds."""
    entries = buckets(docs, W.word_hashes(W.words(F.col(text))), bits, trusted.alias("trusted"))
    counts = [
        entries.where(part).groupBy("bucket").agg(F.count(F.lit(1)).alias("raw"), F.count_if("trusted").alias("target"))
        for part in slices(COUNTED)
    ]
    return reduce(DataFrame.union, [written(c, "grams") for c in counts])


def fit(docs: DataFrame, labels: DataFrame, rules: QualityRules, text: str = "text") -> DataFrame:
    """The model, a row for an n-gram: counts of all texts against those of trusted texts."""
    ids = trusted_ids(labels, rules.target_documents).withColumnRenamed("doc_id", "trusted_id")
    marked = docs.select("doc_id", text).join(
        F.broadcast(ids), F.col("doc_id") == F.col("trusted_id"), "left"
    )
    counts = gram_counts(marked, F.col("trusted_id").isNotNull(), rules.bits, text)
    return log_ratios(counts, rules.prior)


def totals(hashed: DataFrame, model: DataFrame, bits: int) -> DataFrame:
    """scored, total: the sum of the scaled log ratios of each ``row``'s n-grams, if any; of its words, ``hashes``.

    Frequent n-grams meet a broadcast table of bounded size, so that no join key is hot.
    """
    entries = buckets(hashed, F.col("hashes"), bits, F.col("row"))
    often = written(model.where("frequent").select("bucket", "w"), "frequent")
    frequent = F.broadcast(often)
    found = [entries.join(frequent, "bucket")]
    for part in slices(SCORED):
        others = entries.where(part).join(frequent, "bucket", "left_anti")
        found.append(others.join(model.where("NOT frequent").where(part), "bucket"))
    sums = [written(f.groupBy("row").agg(F.sum("w").alias("w")), "sums") for f in found]
    return reduce(DataFrame.union, sums).groupBy(F.col("row").alias("scored")).agg(F.sum("w").alias("total"))


def duplicate_lines(text: Column) -> Column:
    """Lines with a word that equal an earlier line."""
    lines = F.filter(
        F.split(W.whole(text), "\n"), lambda line: F.btrim(line, F.lit(W.BLANKS)) != ""
    )
    return F.when(
        F.contains(W.whole(text), F.lit("\n")), F.size(lines) - F.size(F.array_distinct(lines))
    ).otherwise(0)


#: Bits of a place in a text; the others of a key hold what a window's hash begins with.
PLACE = 31


def repeated_words(hashes: Column) -> Column:
    """Words inside 3-word windows that the text has twice or more, the first included.

    ``hashes`` of the words are bound by ``let`` or a lambda. Whole numbers that begin like a window's
    hash and end with its place are sorted, and only windows that begin alike are compared.
    """

    def window(i: Column) -> Column:
        return F.xxhash64(*[F.get(hashes, i + k) for k in range(3)])

    def alike(keys: Column) -> Column:
        def begin(x: Column, y: Column) -> Column:
            return F.shiftright(x.bitwiseXOR(y), PLACE) == 0

        # Different windows can begin alike: they are told apart next.
        near = F.filter(keys, lambda x, j: begin(x, F.get(keys, j + 1)) | begin(x, F.get(keys, j - 1)))
        return F.transform(near, lambda x: x.bitwiseAND((1 << PLACE) - 1).cast("int"))

    def starts(places: Column) -> Column:
        again = F.filter(
            places,
            lambda x, j: F.coalesce(F.get(places, j + 1)["h"] == x["h"], F.lit(False))
            | ((j > 0) & F.coalesce(F.get(places, j - 1)["h"] == x["h"], F.lit(False))),
        )
        return F.sort_array(F.transform(again, lambda x: x["i"]))

    runs = F.transform(
        hashes,
        lambda h, i: F.xxhash64(h, F.get(hashes, i + 1), F.get(hashes, i + 2)).bitwiseAND(-1 << PLACE).bitwiseOR(i.cast("long")),
    )
    keys = F.sort_array(F.slice(runs, F.lit(1), F.greatest(F.size(hashes) - 2, F.lit(0))))
    places = F.transform(W.let(keys, alike), lambda i: F.struct(window(i).alias("h"), i.alias("i")))
    # A window adds the words that its predecessor has not covered: three at most.
    return F.aggregate(
        W.let(F.sort_array(places), starts),
        F.struct(F.lit(0).alias("n"), F.lit(-3).alias("last")),
        lambda s, i: F.struct((s["n"] + F.least(F.lit(3), i - s["last"])).alias("n"), i.alias("last")),
        lambda s: s["n"],
    )


def counted(docs: DataFrame, text: str, *more: Column, with_text: bool = True) -> DataFrame:
    """Packed input rows with a number ``row``, their counts and the ``hashes`` of their words."""
    symbols = F.regexp_count(W.whole(F.col(text)), F.lit("[#*$%&|<>]"))

    def of_words(words: Column, hashes: Column) -> Column:
        return F.struct(
            F.size(words).cast("long").alias("n_words"),
            F.length(F.array_join(words, "")).cast("long").alias("word_chars"),
            repeated_words(hashes).cast("long").alias("n_repeat_words"),
            F.greatest(2 * F.size(words) - 1, F.lit(0)).cast("long").alias("n_grams"),
            hashes.alias("hashes"),
        )

    counts = W.let(W.words(F.col(text)), lambda w: W.let(W.word_hashes(w), lambda h: of_words(w, h)))
    made = packed(
        docs,
        F.monotonically_increasing_id().alias("row"),
        symbols.cast("long").alias("n_symbols"),
        duplicate_lines(F.col(text)).cast("long").alias("n_dup_lines"),
        counts.alias("of_words"),
        *more,
    )
    carried = ROW if with_text else F.col(ROW).dropFields(text).alias(ROW)
    return made.select("row", carried, "n_symbols", "n_dup_lines", "of_words.*", *made.columns[5:])


def verdicts(measured: DataFrame, rules: QualityRules) -> DataFrame:
    """Input rows with their counts, ``total`` judged by the rules."""
    failed = (F.col("n_words") < rules.least_words) | (
        100 * F.col("n_repeat_words") > rules.most_repeated * F.col("n_words")
    )
    least = round(rules.least_mean * SCALE)
    return unpacked(
        measured,
        n_words=F.col("n_words"),
        word_chars=F.col("word_chars"),
        n_symbols=F.col("n_symbols"),
        n_dup_lines=F.col("n_dup_lines"),
        n_repeat_words=F.col("n_repeat_words"),
        base_failed=failed,
        mean_log_ratio=F.try_divide(F.col("total"), F.col("n_grams") * SCALE),
        kept=~failed & (F.col("total") >= F.lit(least) * F.col("n_grams")),
    )


def quality_rules(
    docs: DataFrame, model: DataFrame, rules: QualityRules = QualityRules(), text: str = "text"
) -> DataFrame:
    """Every input row with its counts, its score and the verdict ``kept``.

    Null or blank text: all counts 0, no score (null), ``base_failed`` true, not kept. Repeated rows
    get equal answers. Texts of any length are read whole. Input columns named like an output are
    replaced.

    Windows are compared by 64-bit hash: two different 3-word windows of one text are taken as equal
    with probability n²/2⁶⁵ for n words.
    """
    rows = written(counted(docs, text), "counted", **NUMBERED)
    sums = totals(rows.select("row", "hashes"), model, rules.bits)
    measured = rows.join(sums, F.col("row") == F.col("scored"), "left").na.fill(0, ["total"])
    return verdicts(measured, rules)


def occurrences(rows: DataFrame, bits: int, part: Column | None = None) -> DataFrame:
    """``gram`` and ``at``, row and trust in one number, of the n-grams whose first ``word`` is in the part."""
    at = F.shiftleft("row", 1).bitwiseOR(F.col("trusted").cast("long")).alias("at")
    starts = rows.select(at, "hashes", F.posexplode("hashes").alias("i", "word"))
    starts = starts if part is None else starts.where(part)
    after = F.get("hashes", F.col("i") + 1)
    pair = F.when(after.isNotNull(), F.xxhash64("word", after))
    grams = starts.select("at", F.explode(F.array("word", pair)).alias("gram")).where("gram IS NOT NULL")
    return grams.select(F.shiftrightunsigned("gram", 64 - bits).alias("gram"), "at")


def first_words(n: int, bits: int) -> list[Column | None]:
    """Conditions of which the first word of each n-gram meets one; n-grams that share bits are not split."""
    return [F.pmod("word", F.lit(n)) == i for i in range(n)] if bits == 64 else [None]


def own_totals(rows: DataFrame, rules: QualityRules, kept: Callable[..., DataFrame]) -> DataFrame:
    """scored, total: the sum of the scaled log ratios of each row's n-grams, if not 0, fitted on all ``rows``.

    An n-gram with one occurrence weighs what its row's trust decides, so only rows that share one are told
    its weight. Frequent n-grams are counted within tasks first, so that no key is hot.
    """
    n, trusted = F.col("n_grams"), F.col("trusted")
    raws, targets = rows.agg(F.sum(n), F.sum(F.when(trusted, n))).first()
    if not targets:
        return rows.limit(0).select(F.col("row").alias("scored"), n.alias("total"))
    weight = lambda raw, target: log_ratio(raw, target, F.lit(targets / raws), rules.prior)
    is_target = F.col("at") % 2 == 1
    counts = F.count(F.lit(1)).alias("raw"), F.count_if(is_target).alias("target")
    ratios = [r["w"] for r in rows.sparkSession.range(2).select(weight(F.lit(1), F.col("id")).alias("w"), "id").sort("id").collect()]
    alone = F.when(is_target, ratios[1]).otherwise(ratios[0])

    probe = rows.where(F.pmod(F.xxhash64("row"), F.lit(PROBED)) == 0)
    probed = probe.agg(F.sum(n)).first()[0] or 0
    often = occurrences(probe, rules.bits).groupBy("gram").agg(F.count(F.lit(1)).alias("n"))
    often = F.broadcast(kept(often.where(F.col("n") > OFTEN * probed).select("gram"), "often"))
    every = occurrences(rows, rules.bits)
    frequent = kept(every.join(often, "gram").groupBy("gram").agg(*counts), "frequent")
    frequent = F.broadcast(frequent.select("gram", weight(F.col("raw"), F.col("target")).alias("w")))
    found = [every.join(frequent, "gram")]
    for part in first_words(JUDGED, rules.bits):
        # One exchange: what is counted there is joined there.
        there = occurrences(rows, rules.bits, part).join(often, "gram", "left_anti").repartition("gram")
        shared = there.groupBy("gram").agg(*counts).where("raw > 1")
        shared = shared.select("gram", weight(F.col("raw"), F.col("target")).alias("w"))
        found.append(there.join(shared.hint("shuffle_hash"), "gram"))
    # Against what the row's n-grams weigh if each of them occurs once.
    more = F.sum(F.col("w") - alone).alias("more")
    sums = reduce(DataFrame.union, [kept(f.groupBy("at").agg(more), "sums") for f in found])
    each = sums.groupBy(F.shiftright("at", 1).alias("scored")).agg(F.sum("more").alias("more"))
    at_least = rows.select("row", "n_grams", trusted.cast("long").alias("at"))
    return at_least.join(each, F.col("row") == F.col("scored"), "left").select(
        F.col("row").alias("scored"), (n * alone + F.coalesce("more", F.lit(0))).alias("total")
    )


def judge(
    docs: DataFrame,
    labels: DataFrame,
    rules: QualityRules = QualityRules(),
    text: str = "text",
    with_text: bool = True,
) -> DataFrame:
    """``quality_rules`` of the documents by the model that ``fit`` makes of the same documents.

    The rows are those that the two return one after the other. Without ``with_text`` texts are read
    but not given back.
    """
    ids = trusted_ids(labels, rules.target_documents).withColumnRenamed("doc_id", "trusted_id")
    made = counted(docs, text, F.col("doc_id").alias("judged_id"), with_text=with_text)
    marked = made.join(F.broadcast(ids), F.col("judged_id") == F.col("trusted_id"), "left")
    marked = marked.withColumn("trusted", F.col("trusted_id").isNotNull()).drop("judged_id", "trusted_id")
    with scratch(docs.sparkSession) as kept:
        rows = kept(marked, "counted", **NUMBERED)
        sums = own_totals(rows, rules, kept)
        measured = rows.drop("hashes").join(sums, F.col("row") == F.col("scored"), "left").na.fill(0, ["total"])
        judged = written(measured, "judged")
    return verdicts(judged, rules)
