"""Near duplicates by bottom-k sketches of shingle sets.

One hash function orders all shingles; a document keeps the ``k`` least of its set. Inverted lists
over runs of retained values bring similar documents together, the sketch of the union estimates
their similarity, and whole sets confirm it. Documents of equal sets count as one from the start.

Two sets of similarity s agree on each of the first values of their union with probability s, so a
run of four common neighbours is missing among 64 values with probability 1e-8 at s = 0.85. Sets
of at most ``k`` shingles are retained whole; there the shorter runs of small sets make a common
run certain. A list needs not all its pairs: members are compared with one member of their list
first. Documents of lists that still hold different groups afterwards are joined once more, by the
rarest shingles of their whole sets: two similar sets share one of the first few, and copies that have
drifted apart, of which there may be many, have rare ones of their own there.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sedimenta.llm import words as W
from sedimenta.llm.components import components
from sedimenta.llm.rows import field, scratch, staged, unpacked, written
from sedimenta.llm.shingles import WordHashes, lowered_words, shingle_set, signature


@dataclass(frozen=True)
class NearDuplicates:
    """Parameters.

    width    words in a shingle
    percent  least similarity of linked documents, in percent
    k        retained values of a document
    run      retained neighbours that make a list
    slack    an estimate so many standard errors below the limit still goes to the exact check
    stars    rounds in which a list compares its members with one of them only
    """

    width: int = 5
    percent: int = 80
    k: int = 64
    run: int = 4
    slack: float = 6.0
    stars: int = 1

    @property
    def least_estimate(self) -> float:
        s = self.percent / 100
        return s - self.slack * (s * (1 - s) / self.k) ** 0.5


#: Sets of fewer shingles also make lists of shorter runs.
SHORTER_RUNS = {3: 24, 2: 9}
#: So many ids of 8 bytes may be sent to every executor; more are joined instead.
MOST_SENT = 500_000


def _sketches(params: NearDuplicates):
    def sketch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes = WordHashes()
        for batch in batches:
            rows = batch.column("row").to_pylist()
            sizes, signs, least = [], [], []
            for row, text in zip(rows, batch.column("text").to_pylist(), strict=True):
                shingles = shingle_set(lowered_words(text), params.width, hashes)
                n = len(shingles)
                sizes.append(n)
                # Empty sets are equal to none: each has a signature of its own.
                signs.append(signature(shingles) if n else b"empty" + row.to_bytes(8, "big"))
                least.append(shingles[: params.k])
            yield pa.RecordBatch.from_arrays(
                [batch.column("row"), pa.array(sizes, pa.int64()), pa.array(signs, pa.binary()), _lists(least)],
                ["row", "n", "sign", "sketch"],
            )

    return sketch


def _lists(arrays: list[np.ndarray]) -> pa.Array:
    ends = np.cumsum([0, *map(len, arrays)]).astype(np.int32)
    values = np.concatenate(arrays) if arrays else np.empty(0, np.int64)
    return pa.ListArray.from_arrays(pa.array(ends), pa.array(values, pa.int64()))


def _similar(params: NearDuplicates):
    """Pairs whose whole sets reach the limit."""

    def similar(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes = WordHashes()
        last, left = None, np.empty(0, np.int64)
        for batch in batches:
            keep = []
            columns = (batch.column(c).to_pylist() for c in ("a", "text_a", "text_b"))
            for a, text_a, text_b in zip(*columns, strict=True):
                if a != last:
                    last, left = a, shingle_set(lowered_words(text_a), params.width, hashes)
                right = shingle_set(lowered_words(text_b), params.width, hashes)
                both = len(np.intersect1d(left, right, assume_unique=True))
                keep.append(100 * both >= params.percent * (len(left) + len(right) - both))
            yield batch.select(["a", "b"]).filter(pa.array(keep, pa.bool_()))

    return similar


def _sizes_fit(n_a: Column, n_b: Column, percent: int) -> Column:
    return 100 * F.least(n_a, n_b) >= percent * F.greatest(n_a, n_b)


def _estimated(pairs: DataFrame, sketches: DataFrame, params: NearDuplicates) -> DataFrame:
    """Pairs that the sketch of their union does not rule out."""
    side = lambda x: sketches.select(F.col("row").alias(x), F.col("sketch").alias(f"sketch_{x}"))
    union = F.slice(F.sort_array(F.array_union("sketch_a", "sketch_b")), 1, params.k)
    both = F.array_intersect("sketch_a", "sketch_b")
    estimate = F.size(F.array_intersect(union, both)) / F.size(union)
    return (
        pairs.join(side("b"), "b").join(side("a"), "a").where(estimate >= params.least_estimate).select("a", "b")
    )


def _confirmed(pairs: DataFrame, texts: DataFrame, params: NearDuplicates) -> DataFrame:
    """Pairs of documents whose whole sets are similar enough."""
    pairs = written(pairs, "candidates")
    nodes = pairs.select(F.explode(F.array("a", "b")).alias("row")).distinct()
    nodes = F.broadcast(nodes) if pairs.count() * 2 <= MOST_SENT else nodes
    involved = written(texts.join(nodes, "row", "left_semi"), "candidate-texts")
    side = lambda x: involved.select(F.col("row").alias(x), F.col("text").alias(f"text_{x}"))
    both = pairs.join(side("b"), "b").join(side("a"), "a").select("a", "b", "text_a", "text_b")
    return written(both.mapInArrow(_similar(params), "a long, b long"), "links")


def _keys(params: NearDuplicates) -> Column:
    """A key for each run of neighbouring retained values; small sets have shorter runs as well."""
    none = F.array().cast("array<long>")

    def runs(sketch: Column) -> Column:
        shorter = [(r, most) for r, most in SHORTER_RUNS.items() if r < params.run]
        more = [F.when(F.col("n") < most, W.windows(sketch, r)).otherwise(none) for r, most in shorter]
        return F.concat(W.windows(sketch, params.run), *more)

    return W.let(F.col("sketch"), runs)


def _members(sketches: DataFrame, params: NearDuplicates) -> DataFrame:
    """Lists with at least two members: key, row, n, and the lists ``seen`` that the row is in."""
    postings = sketches.select("row", "n", F.explode(_keys(params)).alias("key"))
    shared = postings.groupBy("key").agg(F.count(F.lit(1)).alias("members")).where("members > 1").select("key")
    members = written(postings.join(shared, "key", "left_semi"), "lists")
    seen = members.groupBy("row").agg(F.count(F.lit(1)).alias("seen"))
    return written(members.join(seen, "row"), "members")


def _grouped(members: DataFrame, links: DataFrame) -> DataFrame:
    """Members of those lists that still hold different groups, with the group of each."""
    groups = components(links).withColumnRenamed("node", "row")
    with_group = members.join(groups, "row", "left").select(
        "key", "row", "n", "seen", F.coalesce("component", "row").alias("group")
    )
    mixed = with_group.groupBy("key").agg(F.min("group").alias("low"), F.max("group").alias("high"))
    mixed = mixed.where("low < high").select("key")
    return written(with_group.join(mixed, "key", "left_semi"), "open-lists")


def _star(open_lists: DataFrame, params: NearDuplicates) -> DataFrame:
    """Every member with the one of its list that most other lists have, too: what copies stem from."""
    order = F.struct((-F.col("seen")).alias("o"), "row", "n", "group")
    chosen = open_lists.groupBy("key").agg(F.min(order).alias("p"))
    tied = open_lists.join(chosen, "key").where(
        (F.col("group") != F.col("p.group")) & _sizes_fit(F.col("n"), F.col("p.n"), params.percent)
    )
    return tied.select(F.least("row", "p.row").alias("a"), F.greatest("row", "p.row").alias("b")).distinct()


def _set_rows(params: NearDuplicates):
    def sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes = WordHashes()
        for batch in batches:
            found = [shingle_set(lowered_words(t), params.width, hashes) for t in batch.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column("row"), _lists(found)], ["row", "shingles"])

    return sets


def _rarest(open_lists: DataFrame, texts: DataFrame, params: NearDuplicates) -> DataFrame:
    """The first shingles of every open document, rare ones first, with their places from 1.

    Sets of n and m shingles reach the limit s when they share o = s·(n + m) / (1 + s) of them; then
    they share one of the first n - o + 1 and m - o + 1 in any common order. No partner is smaller
    than s·n, so the first n - s·n + 1 are enough.
    """
    rows = written(open_lists.select("row", "n", "group").distinct(), "open-documents")
    ids = rows.select("row")
    sent = F.broadcast(ids) if rows.count() <= MOST_SENT else ids
    sets = texts.join(sent, "row", "left_semi").mapInArrow(_set_rows(params), "row long, shingles array<long>")
    each = written(sets.select("row", F.explode("shingles").alias("shingle")), "open-shingles")
    often = each.groupBy("shingle").agg(F.count(F.lit(1)).alias("often")).where("often > 1")
    # Shingles of one document come first and meet nothing: their number is all that counts.
    counted = each.join(often, "shingle").groupBy("row").agg(
        F.sort_array(F.collect_list(F.struct("often", "shingle"))).alias("shared")
    )
    own = F.col("n") - F.size("shared")
    most = F.col("n") - F.ceil(params.percent * F.col("n") / 100) + 1
    first = counted.join(rows, "row").select(
        "row", "n", "group", own.alias("own"), F.posexplode(F.slice("shared", F.lit(1), F.greatest(most - own, F.lit(0)).cast("int"))).alias("at", "x")
    )
    return written(first.select("row", "n", "group", "x.shingle", (F.col("own") + F.col("at") + 1).alias("place")), "rarest")


def _open_pairs(rarest: DataFrame, params: NearDuplicates) -> DataFrame:
    """Documents of different groups that share one of their first shingles."""
    side = lambda x: rarest.select(*[F.col(c).alias(f"{c}_{x}") for c in rarest.columns])
    both = F.col("n_a") + F.col("n_b")
    overlap = F.ceil(params.percent * both / (100 + params.percent))
    reach = (F.col("place_a") <= F.col("n_a") - overlap + 1) & (F.col("place_b") <= F.col("n_b") - overlap + 1)
    apart = (F.col("row_a") < F.col("row_b")) & (F.col("group_a") != F.col("group_b"))
    pairs = side("a").join(side("b"), (F.col("shingle_a") == F.col("shingle_b")) & apart & reach)
    return pairs.select(F.col("row_a").alias("a"), F.col("row_b").alias("b")).distinct()


def similar_groups(sketches: DataFrame, texts: DataFrame, params: NearDuplicates) -> DataFrame:
    """``node`` and ``component`` of the documents that are linked to another."""
    members = _members(sketches, params)
    open_lists = members.withColumn("group", F.col("row"))
    links = members.select(F.col("row").alias("a"), F.col("row").alias("b")).limit(0)
    for _ in range(params.stars):
        pairs = _star(open_lists, params)
        links = links.union(_confirmed(_estimated(pairs, sketches, params), texts, params))
        open_lists = _grouped(members, links)
    if not open_lists.isEmpty():
        pairs = _open_pairs(_rarest(open_lists, texts, params), params)
        links = links.union(_confirmed(_estimated(pairs, sketches, params), texts, params))
    return components(links)


def near_duplicates(
    docs: DataFrame,
    params: NearDuplicates = NearDuplicates(),
    id_: str = "doc_id",
    text: str = "text",
) -> DataFrame:
    """Every input row with ``n_shingles``, ``component_id`` and ``kept``.

    Two rows are linked when their shingle sets reach the limit; ``component_id`` is the least id
    among all rows reachable. One row of each group is kept, the first in the input of that least
    id. Null and blank texts have an empty set, are linked with nothing and are kept. Null ids count
    as larger than all others: a group of them only has a null ``component_id``. Repeated rows are
    exact copies. Input columns named like an output are replaced.
    """
    rows = staged(docs, "documents")
    texts = rows.select("row", field(text).alias("text"))
    with scratch(docs.sparkSession) as kept:
        sketches = kept(
            texts.mapInArrow(
                _sketches(params), "row long, n long, sign binary, sketch array<long>"
            ),
            "sketches",
        )
        ids = rows.select("row", field(id_).alias("id"))
        first = F.min(F.struct(F.col("id").isNull().alias("none"), "id", "row")).alias("first")
        classes = kept(
            sketches.join(ids, "row").groupBy("sign").agg(F.min("row").alias("node"), first), "classes"
        )
        chosen = classes.select(F.col("node").alias("row"))
        chosen = F.broadcast(chosen) if classes.count() <= MOST_SENT else chosen
        distinct = sketches.join(chosen, "row", "left_semi").where("n > 0")
        groups = similar_groups(distinct, texts, params)
        grouped = classes.join(groups, "node", "left").select(
            "sign", "first", F.coalesce("component", "node").alias("component")
        )
        leaders = grouped.groupBy("component").agg(F.min("first").alias("leader"))
        named = grouped.join(leaders, "component").select("sign", "leader")
        judged = sketches.select("row", "n", "sign").join(named, "sign").select("row", "n", "leader")
        found = written(judged, "judged")
    return unpacked(
        rows.join(found, "row"),
        n_shingles=F.col("n"),
        component_id=F.col("leader.id"),
        kept=F.col("row") == F.col("leader.row"),
    )
