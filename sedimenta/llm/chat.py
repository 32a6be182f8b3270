"""Chat formatting: conversations as budgeted windows of whole turns with a loss mask.

A conversation's turns have prefix sums of tokens, cut into strides. Turns that lie in one stride
share a window, and a turn that goes on into the next stride has one of its own, so no turn depends
on how an earlier window was packed, and the own turns of a window never exceed the stride unless
one alone does. A window opens with the system turn, repeats the last turns of the window before it
as far as the history budget goes, and then has its own turns. Loss falls on the assistant texts
among its own turns only.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from sedimenta.llm import words as W

# The template. Inside roles and texts "<" and "&" are written as entities, so that no
# text can look like a mark; in roles ">" too.
OPEN, BODY, CLOSE = "<turn ", ">\n", "</turn>\n"


@dataclass(frozen=True)
class Budget:
    """Tokens are words between blanks, and two for the marks of a turn.

    stride   a window's own turns have at most so many tokens, but for one longer turn alone
    history  repeated turns before them have at most so many, and no more than ``stride``

    With its system turn a window has at most system + history + stride tokens, or those of the system
    turn, of the history and of one turn longer than the stride.
    """

    stride: int = 512
    history: int = 128


def escaped(text: Column) -> Column:
    return F.replace(F.replace(text, F.lit("&"), F.lit("&amp;")), F.lit("<"), F.lit("&lt;"))


def unescaped(text: Column) -> Column:
    return F.replace(F.replace(text, F.lit("&lt;"), F.lit("<")), F.lit("&amp;"), F.lit("&"))


def escaped_role(role: Column) -> Column:
    return F.replace(escaped(role), F.lit(">"), F.lit("&gt;"))


def unescaped_role(role: Column) -> Column:
    return unescaped(F.replace(role, F.lit("&gt;"), F.lit(">")))


def chat_windows(turns: DataFrame, budget: Budget = Budget()) -> DataFrame:
    """One row for each window: conv_id, window, formatted, loss, repeated, turns, tokens.

    ``formatted`` is the text; ``loss`` the spans of it under the loss mask, as first code point and
    length; ``repeated`` the number of leading turns that an earlier window has as well. Input: rows
    conv_id, turn, role, text in any order; other columns are ignored. Turns of one number are taken
    by role, then text; a null number comes first; null roles and texts are empty. All rows with a
    null conv_id are one conversation. Repeated rows are turns of their own. The system turn is the
    first one, if its role is ``system``. A turn is never cut: one longer than the stride is the only
    one of its window. An empty table has no windows.
    """
    if not 0 <= budget.history <= budget.stride:
        raise ValueError("history must lie between 0 and the stride")
    given = turns.select(
        "conv_id",
        "turn",
        F.coalesce("role", F.lit("")).alias("role"),
        W.whole(F.col("text")).alias("text"),
    ).withColumn("tokens", (F.size(W.words(F.col("text"))) + 2).cast("long"))
    in_order = Window.partitionBy("conv_id").orderBy("turn", "role", "text")
    before = in_order.rowsBetween(Window.unboundedPreceding, -1)
    numbered = given.select(
        "*", F.row_number().over(in_order).alias("place"), F.first("role").over(in_order).alias("opening")
    ).withColumn("is_system", (F.col("place") == 1) & (F.col("opening") == "system"))
    own_tokens = F.when(F.col("is_system"), 0).otherwise(F.col("tokens"))
    system_turn = F.when(F.col("opening") == "system", F.struct("role", "text", "tokens"))
    summed = numbered.select(
        "*",
        F.coalesce(F.sum(own_tokens).over(before), F.lit(0).cast("long")).alias("start"),
        F.first(system_turn).over(in_order).alias("system"),
    )
    # Two windows for a stride: turns that lie in it, and then the one that goes on beyond it.
    stride = F.floor(F.col("start") / budget.stride)
    ends_in = F.floor((F.col("start") + F.col("tokens") - 1) / budget.stride)
    within = F.col("is_system") | (F.col("start") % budget.stride == 0) | (stride == ends_in)
    by_stride = Window.partitionBy("conv_id").orderBy("part")
    summed = summed.withColumn("part", 2 * stride + F.when(within, 0).otherwise(1)).withColumn(
        "window", (F.dense_rank().over(by_stride) - 1).cast("long")
    )
    # Only the next window can repeat a turn.
    following = Window.partitionBy("conv_id").orderBy("window").rangeBetween(1, 1)
    own_start = F.when(~F.col("is_system"), F.col("start"))
    followed = summed.withColumn("next_start", F.min(own_start).over(following))
    repeats = ~F.col("is_system") & (F.col("next_start") - F.col("start") <= budget.history)
    uses = F.concat(
        F.array(F.struct(F.col("window").alias("window"), F.lit(False).alias("again"))),
        F.when(repeats, F.array(F.struct((F.col("window") + 1).alias("window"), F.lit(True).alias("again")))).otherwise(
            F.array().cast("array<struct<window:bigint,again:boolean>>")
        ),
    )
    used = followed.select("conv_id", "place", "role", "text", "tokens", "system", F.explode(uses).alias("use"))
    windows = used.groupBy("conv_id", F.col("use.window").alias("window")).agg(
        F.sort_array(F.collect_list(F.struct("place", F.col("use.again").alias("again"), "role", "text", "tokens"))).alias("own"),
        F.first("system").alias("system"),
    )
    # Later windows get the system turn before their own turns; the first one has it already.
    head = F.when(
        F.col("system").isNotNull() & (F.col("window") > 0),
        F.array(
            F.struct(
                F.lit(0).alias("place"),
                F.lit(True).alias("again"),
                F.col("system.role").alias("role"),
                F.col("system.text").alias("text"),
                F.col("system.tokens").alias("tokens"),
            )
        ),
    ).otherwise(F.slice("own", 1, 0))
    listed = windows.select("conv_id", "window", F.concat(head, F.col("own")).alias("turns"))
    said = F.transform(
        "turns",
        lambda t: F.struct(
            F.concat(F.lit(OPEN), escaped_role(t["role"]), F.lit(BODY)).alias("lead"),
            escaped(t["text"]).alias("body"),
            (~t["again"] & (t["role"] == "assistant")).alias("target"),
        ),
    )
    spans = F.aggregate(
        F.col("said"),
        F.struct(F.lit(0).alias("at"), F.array().cast("array<struct<start:int,length:int>>").alias("out")),
        lambda s, t: F.struct(
            (s["at"] + F.length(t["lead"]) + F.length(t["body"]) + len(CLOSE)).alias("at"),
            F.when(
                t["target"],
                F.array_append(
                    s["out"],
                    F.struct((s["at"] + F.length(t["lead"])).alias("start"), F.length(t["body"]).alias("length")),
                ),
            ).otherwise(s["out"]).alias("out"),
        ),
        lambda s: s["out"],
    )
    text = F.array_join(F.transform("said", lambda t: F.concat(t["lead"], t["body"], F.lit(CLOSE))), "")
    return listed.withColumn("said", said).select(
        "conv_id",
        "window",
        text.alias("formatted"),
        spans.alias("loss"),
        F.size(F.filter("turns", lambda t: t["again"])).alias("repeated"),
        F.size("turns").alias("turns"),
        F.aggregate("turns", F.lit(0).cast("long"), lambda n, t: n + t["tokens"]).alias("tokens"),
    )


def read_turns(formatted: Column) -> Column:
    """Role and text of every turn, read back from a formatted text."""
    pieces = F.split(formatted, CLOSE, -1)
    whole_pieces = F.slice(pieces, F.lit(1), F.size(pieces) - 1)
    return F.transform(
        whole_pieces,
        lambda p: F.struct(
            unescaped_role(F.substring_index(F.substr(p, F.lit(len(OPEN) + 1)), ">", 1)).alias("role"),
            unescaped(F.substr(p, F.instr(p, F.lit(BODY)) + len(BODY))).alias("text"),
        ),
    )


def read_loss(formatted: Column, loss: Column) -> Column:
    """What stands under the loss mask, unescaped, nothing between."""
    return F.array_join(
        F.transform(loss, lambda s: unescaped(F.substr(formatted, s["start"] + 1, s["length"]))), ""
    )


def read_back(windows: DataFrame) -> DataFrame:
    """One row for each conversation: its turns once each and its loss text, from the windows alone."""
    read = windows.select(
        "conv_id",
        "window",
        F.slice(read_turns(F.col("formatted")), F.col("repeated") + 1, F.col("turns")).alias("own"),
        read_loss(F.col("formatted"), F.col("loss")).alias("loss_text"),
        F.length("formatted").cast("long").alias("chars"),
    ).select(
        "conv_id",
        "window",
        F.size("own").cast("long").alias("n"),
        F.array_join(F.transform("own", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), "").alias("said"),
        "loss_text",
        "chars",
    )
    in_order = lambda c: F.array_join(F.transform(F.sort_array(F.collect_list(F.struct("window", c))), lambda w: w[c]), "")
    return read.groupBy("conv_id").agg(
        F.sum("n").alias("n_turns"),
        in_order("said").alias("turns_text"),
        in_order("loss_text").alias("loss_text"),
        F.sum("chars").alias("formatted_chars"),
    )
