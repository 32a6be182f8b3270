"""Uniform shuffle into shards of exact size by a hypergeometric communication matrix.

How many rows each input partition sends to each shard is drawn first, exactly as a uniform random
permutation of all rows would have it. Then partitions permute their rows, send consecutive slices,
and shards permute what they receive. The matrix is drawn down a tree of partitions: a node knows
how many of its rows go to each shard and divides those among its children.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sedimenta.llm.rows import packed, unpacked, written
from sedimenta.llm.words import let


@dataclass(frozen=True)
class Shuffle:
    """``shards`` of rows with counts at most one apart.

    Equal seeds give equal results for input that is read in equal partitions; another split of the same
    rows is another draw.

    fan      children of a node in the tree of partitions
    piece    rows of a shard that are permuted by one task, about
    """

    shards: int = 24
    seed: int = 7
    fan: int = 16
    piece: int = 4096


def uniform(*key: Column) -> Column:
    """A number in [0, 1) that the key decides."""
    return F.shiftrightunsigned(F.xxhash64(*key), 11).cast("double") * F.lit(2.0**-53)


def hypergeometric(total: Column, marked: Column, drawn: Column, u: Column) -> Column:
    """How many of ``drawn`` out of ``total`` are ``marked``, by inversion of ``u``.

    Weights start with 1 at the mode and follow from neighbour to neighbour, to twelve standard
    deviations on either side; what is left out has less weight than ``u`` has digits.
    """

    def scan(n: Column, k: Column, m: Column) -> Column:
        low = F.greatest(F.lit(0).cast("long"), m + k - n)
        high = F.least(m, k)
        mode = F.greatest(low, F.least(high, F.floor((m + 1).cast("double") * (k + 1) / (n + 2)).cast("long")))
        deviation = F.sqrt(
            m.cast("double") * k / n * (n - k).cast("double") / n * (n - m).cast("double") / F.greatest(n - 1, F.lit(1).cast("long"))
        )
        reach = F.ceil(12 * deviation).cast("long") + 12

        def up(x: Column) -> Column:  # weight of x + 1 by that of x
            return ((k - x).cast("double") * (m - x)) / ((x + 1).cast("double") * (n - k - m + x + 1))

        def down(x: Column) -> Column:  # weight of x - 1 by that of x
            return (x.cast("double") * (n - k - m + x)) / ((k - x + 1).cast("double") * (m - x + 1))

        def walk(first: Column, count: Column, step: Column, sign: int, start: Column) -> Column:
            """From the mode outwards; ``goal`` is the weight at which to stop."""
            return F.aggregate(
                F.when(count > 0, F.sequence(F.lit(1).cast("long"), count)).otherwise(F.array().cast("array<long>")),
                start,
                lambda s, i: let(
                    s["w"] * step(first + sign * (i - 1)),
                    lambda w: F.struct(
                        w.alias("w"),
                        (s["sum"] + w).alias("sum"),
                        s["goal"].alias("goal"),
                        F.coalesce(s["x"], F.when(s["sum"] + w > s["goal"], first + sign * i)).alias("x"),
                    ),
                ),
            )

        def state(weight: Column, total_: Column, goal: Column, x: Column) -> Column:
            return F.struct(weight.alias("w"), total_.alias("sum"), goal.alias("goal"), x.alias("x"))

        nothing = F.lit(None).cast("long")
        one, far = F.lit(1.0), F.lit(float("inf"))

        def both(mid: Column, ups: Column, downs: Column) -> Column:
            def run(goal: Column) -> Column:
                hit = F.when(goal < 1.0, mid)
                return let(
                    walk(mid, ups, up, 1, state(one, one, goal, hit)),
                    lambda s: walk(mid, downs, down, -1, state(one, s["sum"], goal, s["x"])),
                )

            return let(run(far)["sum"], lambda weight: F.coalesce(run(u * weight)["x"], mid))

        return let(
            F.struct(mode.alias("mode"), F.least(high - mode, reach).alias("ups"), F.least(mode - low, reach).alias("downs")),
            lambda b: both(b["mode"], b["ups"], b["downs"]),
        )

    sure = F.when((drawn == 0) | (marked == 0), F.lit(0).cast("long")).when(marked == total, drawn).when(drawn == total, marked)
    return let(F.struct(total.alias("n"), marked.alias("k"), drawn.alias("m")), lambda a: F.coalesce(sure, scan(a["n"], a["k"], a["m"])))


def divided(sizes: Column, quotas: Column, *key: Column) -> Column:
    """For each child size one array: how many of its rows go to each shard.

    Child after child draws its rows from what is left of the quotas, shard after shard.
    """

    def child(s: Column, size: Column, place: Column) -> Column:
        def shard(t: Column, quota: Column, j: Column) -> Column:
            take = hypergeometric(t["total"], quota, t["drawn"], uniform(*key, place, j))
            return let(
                take,
                lambda x: F.struct(
                    (t["total"] - quota).alias("total"),
                    (t["drawn"] - x).alias("drawn"),
                    (t["j"] + 1).alias("j"),
                    F.array_append(t["out"], x).alias("out"),
                ),
            )

        empty = F.array().cast("array<long>")
        total = F.aggregate(s["left"], F.lit(0).cast("long"), lambda a, b: a + b)
        row = F.aggregate(
            s["left"],
            F.struct(total.alias("total"), size.alias("drawn"), F.lit(0).alias("j"), empty.alias("out")),
            lambda t, quota: shard(t, quota, t["j"]),
            lambda t: t["out"],
        )
        return let(
            row,
            lambda r: F.struct(
                F.zip_with(s["left"], r, lambda a, b: a - b).alias("left"),
                F.array_append(s["out"], r).alias("out"),
                (s["place"] + 1).alias("place"),
            ),
        )

    start = F.struct(quotas.alias("left"), F.array().cast("array<array<long>>").alias("out"), F.lit(0).alias("place"))
    return F.aggregate(sizes, start, lambda s, size: child(s, size, s["place"]), lambda s: s["out"])


def communication_matrix(counts: DataFrame, shuffle: Shuffle) -> DataFrame:
    """``part`` and ``ends``: the places in the partition at which the slice of each shard ends.

    ``counts`` has ``part`` (whole numbers from 0) and ``n``.
    """
    spark = counts.sparkSession
    top, rows = counts.agg(F.max("part"), F.coalesce(F.sum("n"), F.lit(0))).first()
    levels = [counts.select(F.col("part").alias("node"), "n")]
    while top:
        top //= shuffle.fan
        up = levels[-1].groupBy(F.floor(F.col("node") / shuffle.fan).cast("long").alias("node"))
        levels.append(written(up.agg(F.sum("n").alias("n")), "tree"))
    quotas = [rows // shuffle.shards + (j < rows % shuffle.shards) for j in range(shuffle.shards)]
    schema = T.StructType([T.StructField("node", T.LongType()), T.StructField("quotas", T.ArrayType(T.LongType()))])
    drawn = spark.createDataFrame([(0, quotas)], schema)
    for depth in range(len(levels) - 2, -1, -1):
        # At most ``fan`` children to a node.
        children = levels[depth].groupBy(F.floor(F.col("node") / shuffle.fan).cast("long").alias("node")).agg(
            F.sort_array(F.collect_list(F.struct(F.col("node").alias("child"), "n"))).alias("children")
        )
        key = (F.lit(shuffle.seed), F.lit(depth), F.col("node"))
        shared = children.join(drawn, "node").select(
            "children", divided(F.transform("children", lambda c: c["n"]), F.col("quotas"), *key).alias("out")
        )
        pairs = F.explode(F.arrays_zip(F.transform("children", lambda c: c["child"]).alias("node"), F.col("out").alias("quotas")))
        drawn = written(shared.select(pairs.alias("x")).select("x.node", "x.quotas"), "matrix")
    ends = F.aggregate(
        "quotas",
        F.array().cast("array<long>"),
        lambda out, x: F.array_append(out, x + F.coalesce(F.element_at(F.concat(F.array(F.lit(0).cast("long")), out), -1), F.lit(0))),
    )
    return written(drawn.select(F.col("node").alias("part"), ends.alias("ends")), "ends")


def random_shards(docs: DataFrame, shuffle: Shuffle = Shuffle()) -> DataFrame:
    """Every input row with ``shard`` and ``slot``, its place in the shard, from 0 without gaps.

    Every assignment of rows to places is equally likely. Shards differ by one row at most, the
    first ones having more. Null values, empty and long texts and repeated rows are rows like any
    other, and no value of a column decides where a row goes; an empty table has no rows. Input
    columns named like an output are replaced. Rows come back in no order within the table: read a
    shard by ``slot``.
    """
    hashed = [c for c in docs.schema.fields if "map" not in c.dataType.simpleString() and "variant" not in c.dataType.simpleString()]
    key = F.xxhash64(F.lit(shuffle.seed), *[F.col(f"r.`{c.name}`") for c in hashed])
    # A partition is what one task reads; sorting by random keys permutes it, and the running
    # numbers of its rows, less the number of the partition in their upper bits, are their places.
    permuted = packed(docs).withColumn("k", key).sortWithinPartitions("k")
    number = F.monotonically_increasing_id()
    rows = written(
        permuted.select(F.shiftright(number, 33).alias("part"), number.bitwiseAND((1 << 33) - 1).alias("place"), "r"),
        "permuted",
    )
    counts = written(rows.groupBy("part").agg(F.count(F.lit(1)).alias("n")), "counts")
    ends = communication_matrix(counts, shuffle)
    total = counts.agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0]
    pieces = max(1, -(-total // (shuffle.shards * shuffle.piece)))
    # The matrix is small, but grows with the partitions: Spark broadcasts it if its size allows.
    slices = rows.join(ends, "part").select(
        "r",
        F.size(F.filter("ends", lambda end: end <= F.col("place"))).alias("shard"),
        F.xxhash64(F.lit(shuffle.seed + 1), "part", "place").alias("k2"),
    )
    piece = F.pmod("k2", F.lit(pieces))
    sent = slices.withColumn("piece", piece)
    sizes = written(sent.groupBy("shard", "piece").agg(F.count(F.lit(1)).alias("n")), "pieces")
    earlier = Window.partitionBy("shard").orderBy("piece").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sizes.select("shard", "piece", F.coalesce(F.sum("n").over(earlier), F.lit(0).cast("long")).alias("offset"))
    within = Window.partitionBy("shard", "piece").orderBy("k2")
    placed = sent.join(offsets, ["shard", "piece"]).withColumn("slot", F.col("offset") + F.row_number().over(within) - 1)
    return unpacked(placed, shard=F.col("shard"), slot=F.col("slot").cast("long"))
