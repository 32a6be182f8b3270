"""Quality classifier: importance resampling with n-gram models and Gumbel top-k.

The log weight of a document is the sum over its distinct n-grams of the log ratio of two generative
models, one of target texts and one of all texts; a text that says one thing a thousand times counts
it once in either model. A document itself is left out of both models when it is scored, so that a
trusted document and one like it without a label are judged alike. Adding Gumbel noise to the log
weights and taking the k largest draws k documents without replacement in proportion to their weights.

The models are tables keyed by the 64-bit hash of an n-gram: they grow with the corpus, and meet the
documents in a join. N-grams of a single document say nothing about it once it is left out.

``draw`` fits and scores the same documents: each distinct n-gram of a document is shuffled once, a
slice of them after the other, and counted and weighed where it arrives. No model table is kept.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from sedimenta.llm import words as W
from sedimenta.llm.quality import FREQUENT, NUMBERED, OFTEN, PROBED, SCALE, first_words, trusted_ids
from sedimenta.llm.rows import ROW, field, packed, scratch, unpacked, written


@dataclass(frozen=True)
class Resampling:
    """Parameters.

    pseudo           target documents added to what an n-gram has and to what its share of all
                     documents lets expect: so many by chance more or less are no evidence
    target_documents the target model is fitted on at most so many documents
    """

    pseudo: float = 20.0
    target_documents: int = 20_000
    seed: int = 5


#: Parts over which the rows of a hot n-gram are dealt.
PARTS = 64
#: Slices of the n-grams where fitted documents are scored, told by the first word.
DRAWN = 12
#: Documents whose n-grams are told apart at a time within a task.
MARKED = 512


@dataclass(frozen=True)
class Model:
    """``counts``: gram, raw and target documents that have it, of n-grams in two documents or more;
    ``trusted``: ids of the target documents; ``share``: n-grams of target documents among all;
    ``entries``: n-grams of all documents."""

    counts: DataFrame
    trusted: DataFrame
    share: float
    entries: int

    @property
    def hot(self) -> Column:
        """Whether an n-gram has more than its share of all entries: fewer than 10,000 have, ever."""
        return F.col("raw") > FREQUENT * self.entries


def distinct_grams(text: Column) -> Column:
    return F.array_distinct(W.grams(W.word_hashes(W.words(text))))


def fit(docs: DataFrame, labels: DataFrame, params: Resampling, text: str = "text") -> Model:
    """Documents that have an n-gram, among all and among the trusted ones."""
    trusted = written(trusted_ids(labels, params.target_documents).withColumnRenamed("doc_id", "trusted_id"), "trusted")
    marked = docs.select("doc_id", text).join(F.broadcast(trusted), F.col("doc_id") == F.col("trusted_id"), "left")
    seen = Observation()
    counts = (
        marked.select(F.col("trusted_id").isNotNull().alias("trusted"), F.explode(distinct_grams(F.col(text))).alias("gram"))
        .groupBy("gram")
        .agg(F.count(F.lit(1)).alias("raw"), F.count_if("trusted").alias("target"))
        .observe(seen, F.sum("raw").alias("raws"), F.sum("target").alias("targets"))
        .where("raw > 1")
    )
    kept = written(counts, "grams")
    raws, targets = (seen.get.get(name) or 0 for name in ("raws", "targets"))
    return Model(kept, trusted, targets / raws if raws else 0.0, raws)


def gram_weights(model: Model, params: Resampling) -> DataFrame:
    """gram, ``hot``, its scaled log ratio in an unlabelled document, ``own``, and in a trusted one, ``own_trusted``.

    Each is the ratio that the other documents give. Without trusted n-grams every ratio is 0.
    """
    if not model.share:
        return model.counts.limit(0).select("gram", model.hot.alias("hot"), F.col("raw").alias("own"), F.col("raw").alias("own_trusted"))

    def ratio(target: Column) -> Column:
        expected = F.lit(model.share) * (F.col("raw") - 1)
        return F.round(F.log((target + params.pseudo) / (expected + params.pseudo)) * SCALE).cast("long")

    others = F.greatest(F.col("target") - 1, F.lit(0).cast("long"))
    return model.counts.select(
        "gram", model.hot.alias("hot"), ratio(F.col("target")).alias("own"), ratio(others).alias("own_trusted")
    )


def spread(entries: DataFrame, model: Model) -> DataFrame:
    """Entries with ``part``: those of an n-gram that many rows have are dealt over the parts."""
    hot = F.broadcast(model.counts.where(model.hot).select(F.col("gram").alias("hot")))
    part = F.when(F.col("hot").isNotNull(), F.pmod("row", F.lit(PARTS))).otherwise(F.lit(0))
    return entries.join(hot, F.col("gram") == F.col("hot"), "left").select("row", "trusted", "gram", part.cast("int").alias("part"))


def spread_weights(model: Model, params: Resampling) -> DataFrame:
    """Weights of n-grams, those of the hot ones once for each part."""
    parts = F.when(F.col("hot"), F.sequence(F.lit(0), F.lit(PARTS - 1))).otherwise(F.array(F.lit(0)))
    return gram_weights(model, params).withColumn("part", F.explode(parts)).drop("hot")


def gumbel(*key: Column) -> Column:
    """Standard Gumbel noise that the key decides, from a number inside (0, 1)."""
    u = (F.shiftrightunsigned(F.xxhash64(*key), 11).cast("double") + 0.5) * F.lit(2.0**-53)
    return -F.log(-F.log(u))


#: Bars of one histogram, and rows of one bar that are ranked without another histogram.
BARS, RANKED = 4096, 10_000


def top(keys: DataFrame, k: int) -> DataFrame:
    """``row`` of the ``k`` rows with the largest ``key``, equal ones by row; nothing is sorted whole.

    A histogram between the least and the largest key finds the bar in which the last row falls, the
    next one looks at that bar alone, until it holds few rows or equal keys. Those are ranked.
    """
    low, high, n = keys.agg(F.min("key"), F.max("key"), F.count(F.lit(1))).first()
    if k >= n or k <= 0:
        return keys.select("row").where(F.lit(k > 0))
    taken = 0  # rows above ``high``; the last row that is wanted lies between low and high
    inside = n
    while inside > RANKED and low < high:
        width = (high - low) / BARS
        if low + width == low or high - width == high:
            break
        bar = F.least(F.floor((F.col("key") - low) / width), F.lit(BARS - 1)).cast("int")
        within = keys.where(F.col("key").between(low, high))
        bars = within.groupBy(bar.alias("bar")).agg(
            F.count(F.lit(1)).alias("n"), F.min("key").alias("low"), F.max("key").alias("high")
        )
        for found in sorted(bars.collect(), key=lambda b: -b["bar"]):  # at most BARS rows
            if taken + found["n"] >= k:
                break
            taken += found["n"]
        low, high, inside = found["low"], found["high"], found["n"]
    edge = keys.where(F.col("key").between(low, high))
    ranked = edge.orderBy(F.col("key").desc(), "row").limit(k - taken).select("row")
    return keys.where(F.col("key") > high).select("row").union(ranked)


def drawn(rows: DataFrame, totals: DataFrame, k: int | None) -> DataFrame:
    """``rows`` with ``weight``, ``key`` and ``chosen``, null but for ``k`` of them; ``totals``: scored, total."""
    weight = F.coalesce("total", F.lit(0)) / SCALE
    keys = written(
        rows.select("row", "noise").join(totals, F.col("row") == F.col("scored"), "left")
        .select("row", weight.alias("weight"), (weight + F.col("noise")).alias("key")),
        "scored",
    )
    if k is None:
        part = F.exp(F.least(F.lit(0.0), F.col("weight")))
        k = round(keys.agg(F.coalesce(F.sum(F.round(part * SCALE).cast("long")), F.lit(0))).first()[0] / SCALE)
    chosen = top(keys.select("row", "key"), k).withColumnRenamed("row", "chosen")
    judged = keys.join(chosen, F.col("row") == F.col("chosen"), "left").withColumnRenamed("row", "judged")
    return rows.join(judged, F.col("row") == F.col("judged"))


def verdicts(judged: DataFrame) -> DataFrame:
    """Input rows with what was drawn."""
    return unpacked(
        judged, n_grams=F.col("n"), log_weight=F.col("weight"), key=F.col("key"), kept=F.col("chosen").isNotNull()
    )


def resample(
    docs: DataFrame,
    model: Model,
    params: Resampling = Resampling(),
    k: int | None = None,
    id_: str = "doc_id",
    text: str = "text",
) -> DataFrame:
    """Every input row with ``n_grams``, ``log_weight``, ``key`` and ``kept``, true for k rows.

    ``docs`` are those that the model was fitted on. Without ``k`` the number drawn is the sum of all
    weights, no document counting more than once: what the raw texts hold of target-like ones. Null
    and empty texts have no n-grams and the log weight 0; they are drawn like any other row. Repeated
    rows have equal keys, the earlier one first. Input columns named like an output are replaced.
    """
    grams = distinct_grams(F.col(text))
    noise = gumbel(F.lit(params.seed), F.col(id_), F.col(text))
    numbered = packed(docs, F.monotonically_increasing_id().alias("row"), noise.alias("noise"), F.size(grams).cast("long").alias("n"))
    rows = written(numbered, "numbered")
    labelled = rows.select("row", field(id_).alias("id"), field(text).alias("text")).join(
        F.broadcast(model.trusted), F.col("id") == F.col("trusted_id"), "left"
    )
    entries = labelled.select(
        "row", F.col("trusted_id").isNotNull().alias("trusted"), F.explode(distinct_grams(F.col("text"))).alias("gram")
    )
    found = spread(entries, model).join(spread_weights(model, params), ["gram", "part"])
    found = found.select("row", F.when(F.col("trusted"), F.col("own_trusted")).otherwise(F.col("own")).alias("w"))
    totals = found.groupBy(F.col("row").alias("scored")).agg(F.sum("w").alias("total"))
    return verdicts(drawn(rows, totals, k))


def first_times(keys: np.ndarray, of: np.ndarray) -> np.ndarray:
    """Whether each key is the first of its kind in its document; ``of``, ascending, numbers those."""
    order = np.argsort(keys, kind="stable")
    sorted_keys, sorted_of = keys[order], of[order]
    again = (sorted_keys[1:] == sorted_keys[:-1]) & (sorted_of[1:] == sorted_of[:-1])
    first = np.ones(len(keys), dtype=bool)
    first[order[1:][again]] = False
    return first


def marks(hashes: pa.Array) -> pa.Array:
    """For the word hashes of each document: 1 where a word, 2 more where a pair that begins there is
    new in it, and ``n``, how many are."""
    made = [marked(hashes.slice(at, MARKED)) for at in range(0, max(1, len(hashes)), MARKED)]
    return pa.concat_arrays(made)


def marked(hashes: pa.Array) -> pa.Array:
    sizes = np.diff(hashes.offsets.to_numpy())
    words = hashes.flatten().to_numpy().view(np.uint64)
    of = np.repeat(np.arange(len(sizes)), sizes)
    flags = first_times(words, of).astype(np.int8)
    begins = np.flatnonzero(of[1:] == of[:-1])
    after = words[begins + 1]
    # Odd factors: as far apart as the hashes of the words, and not alike in either order.
    pairs = words[begins] * np.uint64(0x9E3779B97F4A7C15) + (after ^ (after >> np.uint64(29))) * np.uint64(0xC2B2AE3D27D4EB4F)
    flags[begins] += 2 * first_times(pairs, of[begins]).astype(np.int8)
    ends = np.concatenate([[0], np.cumsum(sizes)])
    sums = np.concatenate([[0], np.cumsum((flags & 1) + (flags >> 1), dtype=np.int64)])
    firsts = pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(flags))
    return pa.StructArray.from_arrays([firsts, pa.array(np.diff(sums[ends]))], ["firsts", "n"])


def occurrences(rows: DataFrame, part: Column | None = None) -> DataFrame:
    """``gram`` and ``at``, row and trust in one number, of a row's distinct n-grams whose first ``word`` is in the part."""
    at = F.shiftleft("row", 1).bitwiseOR(F.col("trusted").cast("long")).alias("at")
    starts = rows.select(at, "hashes", "firsts", F.posexplode("hashes").alias("i", "word"))
    starts = starts if part is None else starts.where(part)
    new = F.get("firsts", F.col("i"))
    pair = F.xxhash64("word", F.get("hashes", F.col("i") + 1))
    both = F.array(F.when(new.bitwiseAND(F.lit(1).cast("tinyint")) != 0, F.col("word")), F.when(new > 1, pair))
    return starts.select("at", F.explode(both).alias("gram")).where("gram IS NOT NULL").select("gram", "at")


def weighed(share: float, pseudo: float) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """For ``gram``, sorted, and ``at``: ``at`` and the weight ``w`` of the n-grams of two documents or more."""

    def ratio(target: np.ndarray, raw: np.ndarray) -> np.ndarray:
        scaled = np.log((target + pseudo) / (share * (raw - 1) + pseudo)) * SCALE
        return (np.sign(scaled) * np.floor(np.abs(scaled) + 0.5)).astype(np.int64)

    def runs(at: np.ndarray, starts: np.ndarray) -> pa.RecordBatch:
        raw = np.diff(np.append(starts, len(at)))
        shared = raw > 1
        target = np.add.reduceat(at & 1, starts)[shared] if len(starts) else raw
        at, raw = at[np.repeat(shared, raw)], raw[shared]
        own, own_trusted = ratio(target, raw), ratio(np.maximum(target - 1, 0), raw)
        w = np.where(at & 1, np.repeat(own_trusted, raw), np.repeat(own, raw))
        return pa.RecordBatch.from_arrays([pa.array(at), pa.array(w)], ["at", "w"])

    def weigh(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        gram = at = np.empty(0, dtype=np.int64)  # of the last n-gram, which the next batch may go on with
        for batch in batches:
            gram = np.concatenate([gram, batch.column(0).to_numpy()])
            at = np.concatenate([at, batch.column(1).to_numpy()])
            edges = np.flatnonzero(gram[1:] != gram[:-1]) + 1
            if len(edges):
                yield runs(at[: edges[-1]], np.append(0, edges[:-1]))
                gram, at = gram[edges[-1] :], at[edges[-1] :]
        if len(at):
            yield runs(at, np.zeros(1, dtype=np.int64))

    return weigh


def own_totals(rows: DataFrame, params: Resampling, kept: Callable[..., DataFrame]) -> DataFrame:
    """scored, total: the sum of the scaled log ratios of each row's distinct n-grams, fitted on all ``rows``.

    Frequent n-grams are counted within tasks first and meet a broadcast table, so that no key is hot.
    """
    raws, targets = rows.agg(F.sum("n"), F.sum(F.when(F.col("trusted"), F.col("n")))).first()
    if not targets:
        return rows.limit(0).select(F.col("row").alias("scored"), F.col("n").alias("total"))
    probe = rows.where(F.pmod(F.xxhash64("row"), F.lit(PROBED)) == 0)
    probed = probe.agg(F.sum("n")).first()[0] or 0
    often = occurrences(probe).groupBy("gram").agg(F.count(F.lit(1)).alias("n"))
    often = F.broadcast(kept(often.where(F.col("n") > OFTEN * probed).select("gram"), "often"))
    every = occurrences(rows)
    is_target = F.col("at") % 2 == 1
    counts = every.join(often, "gram").groupBy("gram").agg(F.count(F.lit(1)).alias("raw"), F.count_if(is_target).alias("target"))
    model = Model(kept(counts.where("raw > 1"), "frequent"), rows, targets / raws, raws)
    weights = F.broadcast(gram_weights(model, params).drop("hot"))
    w = F.when(is_target, F.col("own_trusted")).otherwise(F.col("own")).alias("w")
    found = [every.join(weights, "gram").select("at", w)]
    for part in first_words(DRAWN, 64):
        there = occurrences(rows, part).join(often, "gram", "left_anti").repartition("gram").sortWithinPartitions("gram")
        found.append(there.mapInArrow(weighed(targets / raws, params.pseudo), "at long, w long"))
    sums = [kept(f.groupBy("at").agg(F.sum("w").alias("w")), "sums") for f in found]
    return reduce(DataFrame.union, sums).groupBy(F.shiftright("at", 1).alias("scored")).agg(F.sum("w").alias("total"))


def draw(
    docs: DataFrame,
    labels: DataFrame,
    params: Resampling = Resampling(),
    k: int | None = None,
    text: str = "text",
    with_text: bool = True,
) -> DataFrame:
    """``resample`` of the documents by the model that ``fit`` makes of the same documents.

    The rows are those that the two return one after the other. Without ``with_text`` texts are read
    but not given back.
    """
    ids = trusted_ids(labels, params.target_documents).withColumnRenamed("doc_id", "trusted_id")
    hashed = packed(
        docs,
        F.monotonically_increasing_id().alias("row"),
        gumbel(F.lit(params.seed), F.col("doc_id"), F.col(text)).alias("noise"),
        F.col("doc_id").alias("judged_id"),
        W.word_hashes(W.words(F.col(text))).alias("hashes"),
    )
    carried = ROW if with_text else F.col(ROW).dropFields(text).alias(ROW)
    numbered = hashed.join(F.broadcast(ids), F.col("judged_id") == F.col("trusted_id"), "left").select(
        "row", carried, "noise", F.col("trusted_id").isNotNull().alias("trusted"), "hashes"
    )
    of_row = F.arrow_udf(marks, "struct<firsts: array<tinyint>, n: bigint>")("hashes")
    numbered = numbered.withColumn("marks", of_row).select("*", "marks.*").drop("marks")
    with scratch(docs.sparkSession) as kept:
        rows = kept(numbered, "numbered", **NUMBERED)
        judged = written(drawn(rows.drop("hashes", "firsts"), own_totals(rows, params, kept), k), "judged")
    return verdicts(judged)
