"""Mixing sources to target weights by pivotal dependent rounding.

Every document of a source is wanted equally often: target by size of the source. Whole copies are
sure, the rest is a probability. Two documents at a time pass on words of their probabilities until
one of them is certain; the words that are expected of the two stay the same, so all that a source's
taken words can miss is what the last undecided document is rounded by. Blocks of a source are
rounded side by side, and what each leaves undecided goes up a tree of blocks.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from sedimenta.llm import words as W
from sedimenta.llm.rows import field, packed, quoted, unpacked, written


@dataclass(frozen=True)
class Mixture:
    """Parameters.

    weights      of the sources in order of their names, over and over
    share        of all sizes that the mix takes
    most         times its size that a source may give at most
    block        rows that one task rounds, about
    fan          blocks whose rests meet in the next level of the tree
    """

    weights: tuple[int, ...] = (3, 1, 2)
    share: float = 1.5
    most: int = 2
    block: int = 4096
    fan: int = 32
    seed: int = 11


def word_count(text: Column) -> Column:
    return F.size(W.words(text)).cast("long")


def source_targets(sizes: DataFrame, mixture: Mixture) -> DataFrame:
    """source, source_size, target from one row ``source``, ``source_size`` for each source.

    Sources are few next to documents: one task ranks them. Where a source is at its limit, the
    others share what is over by weight. With the sources in order of limit by weight, those up to
    some place are at their limits, and the rest share one level: words for each unit of weight.
    """
    by_name = Window.orderBy(F.col("source").asc_nulls_last())
    cycle = F.array(*[F.lit(w) for w in mixture.weights])
    weighed = sizes.select(
        "source",
        "source_size",
        F.get(cycle, ((F.row_number().over(by_name) - 1) % len(mixture.weights)).cast("int")).cast("double").alias("weight"),
        (mixture.most * F.col("source_size")).cast("double").alias("limit"),
    )
    order = Window.orderBy(F.col("limit") / F.col("weight"), F.col("source").asc_nulls_last())
    everything = Window.partitionBy()
    level = (
        mixture.share * F.sum("source_size").over(everything)
        - F.coalesce(F.sum("limit").over(order.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0.0))
    ) / F.sum("weight").over(order.rowsBetween(0, Window.unboundedFollowing))
    levels = weighed.select("*", level.alias("level"), F.row_number().over(order).alias("place"))
    free = F.when(F.col("limit") > F.col("level") * F.col("weight"), F.struct("place", "level"))
    shared = F.min(free).over(everything)["level"]
    target = F.coalesce(F.least(F.col("limit"), shared * F.col("weight")), F.col("limit"))
    return levels.select("source", "source_size", target.alias("target"))


def pivot(sizes: np.ndarray, shares: np.ndarray, random: np.random.Generator) -> np.ndarray:
    """Shares rounded to 0 or 1 but for one at most; the sum of size times share does not change."""
    out = shares.astype(float)
    rest = -1
    draws = random.random(len(out))
    for at in range(len(out)):
        if not 0.0 < out[at] < 1.0:
            continue
        if sizes[at] == 0:
            out[at] = float(draws[at] < out[at])
            continue
        if rest < 0:
            rest = at
            continue
        a, b = sizes[rest], sizes[at]
        to_at = min(a * out[rest], b * (1.0 - out[at]))
        to_rest = min(b * out[at], a * (1.0 - out[rest]))
        if draws[at] * (to_at + to_rest) < to_rest:
            emptied = a * out[rest] <= b * (1.0 - out[at])
            new_rest = 0.0 if emptied else out[rest] - to_at / a
            new_at = 1.0 if not emptied else min(1.0, out[at] + to_at / b)
        else:
            emptied = b * out[at] <= a * (1.0 - out[rest])
            new_at = 0.0 if emptied else out[at] - to_rest / b
            new_rest = 1.0 if not emptied else min(1.0, out[rest] + to_rest / a)
        out[rest], out[at] = new_rest, new_at
        if not 0.0 < out[rest] < 1.0:
            rest = at if 0.0 < out[at] < 1.0 else -1
    return out


def _rounded(mixture: Mixture, level: int, last: bool):
    def block(rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values(["k", "size", "row"], ignore_index=True)
        seed = [mixture.seed, level, *(int(rows[c].iloc[0]) & 0xFFFFFFFFFFFFFFFF for c in ("source_key", "group"))]
        random = np.random.default_rng(seed)
        shares = pivot(rows["size"].to_numpy(float), rows["share"].to_numpy(float), random)
        if last:
            open_ = (shares > 0.0) & (shares < 1.0)
            shares[open_] = random.random(open_.sum()) < shares[open_]
        return rows.assign(share=shares)

    return block


STATE = "row long, source_key long, block long, k long, size long, share double"


def rounded(shares: DataFrame, blocks: int, mixture: Mixture) -> DataFrame:
    """``row`` and ``extra``, 0 or 1: the outcome of every share.

    ``blocks`` is the largest number of blocks of a source.
    """
    spans, reach = [1], 1
    while reach < blocks:
        reach *= mixture.fan
        spans.append(reach)
    left, decided = shares, []
    schema = STATE + ", `group` long"
    for level, span in enumerate(spans):
        last = level == len(spans) - 1
        grouped = left.withColumn("group", F.floor(F.col("block") / span).cast("long"))
        outcome = written(
            grouped.groupBy("source_key", "group").applyInPandas(_rounded(mixture, level, last), schema).drop("group"), "rounded"
        )
        whole = F.col("share").isin(0.0, 1.0)
        decided.append(outcome.where(whole).select("row", F.col("share").cast("int").alias("extra")))
        left = outcome.where(~whole)
    out = decided[0]
    for more in decided[1:]:
        out = out.union(more)
    return out


def mix(docs: DataFrame, size: Column, mixture: Mixture = Mixture(), source: str = "source") -> DataFrame:
    """Every input row with ``size``, ``source_size``, ``target``, ``copies`` and ``taken``.

    ``copies`` of each row are in the mix, ``taken`` words in all. A null source is one of its own,
    the last. Rows of size 0 count no words; a source of such rows has the target 0. Null and empty
    texts have the size that ``size`` gives them; null sizes count as 0. Repeated rows are rounded
    each by itself. The draw depends on the values of a row, not on its place. Input columns named
    like an output are replaced.
    """
    # Places decide nothing but which of two equal rows is which.
    words = F.coalesce(size.cast("long"), F.lit(0).cast("long")).alias("size")
    rows = written(packed(docs, F.monotonically_increasing_id().alias("row"), words), "mixture")
    hashed = [c.name for c in docs.schema.fields if "map" not in c.dataType.simpleString() and "variant" not in c.dataType.simpleString()]
    narrow = rows.select(
        "row",
        field(source).alias("source"),
        "size",
        F.xxhash64(F.lit(mixture.seed), *[field(c) for c in hashed]).alias("k"),
    )
    by_source = written(
        narrow.groupBy("source").agg(F.sum("size").alias("source_size"), F.count(F.lit(1)).alias("n")), "sources"
    )
    blocks = F.ceil(F.col("n") / mixture.block)
    targets = source_targets(by_source, mixture).join(
        by_source.select(F.col("source").alias("name"), blocks.alias("blocks")), F.col("source").eqNullSafe(F.col("name"))
    ).drop("name")
    rate = F.coalesce(F.try_divide("target", F.col("source_size").cast("double")), F.lit(0.0))
    targets = written(targets.withColumn("rate", F.least(rate, F.lit(float(mixture.most)))), "targets")
    # A row for each source, few next to documents; Spark broadcasts it if its size allows.
    known = narrow.withColumnRenamed("source", "own").join(targets, F.col("own").eqNullSafe(F.col("source")))
    sure = F.floor("rate").cast("int")
    state = known.select(
        "row",
        F.xxhash64(F.col("source").isNull(), "source").alias("source_key"),
        F.pmod(F.xxhash64("k"), "blocks").alias("block"),
        "k",
        "size",
        (F.col("rate") - sure).alias("share"),
    )
    most = targets.agg(F.coalesce(F.max("blocks"), F.lit(1))).first()[0]
    extra = rounded(state, most, mixture)
    copied = known.select("row", "source_size", "target", sure.alias("sure")).join(extra, "row")
    joined = rows.join(copied.select("row", "source_size", "target", (F.col("sure") + F.col("extra")).alias("copies")), "row")
    return unpacked(
        joined,
        size=F.col("size"),
        source_size=F.col("source_size"),
        target=F.col("target"),
        copies=F.col("copies"),
        taken=F.col("copies") * F.col("size"),
    )


def repeated(mixed: DataFrame, columns: list[str]) -> DataFrame:
    """The mix itself: every row as often as it is taken."""
    copies = F.explode(F.array_repeat(F.lit(0), F.col("copies")))
    again = mixed.where("copies > 0").select(F.struct(*[quoted(c) for c in columns]).alias("row"), copies.alias("copy"))
    return again.select(*[F.col("row").getField(c).alias(c) for c in columns])
