"""Secret scans: fixed patterns, and candidate strings whose sliding-window entropy is high.

A text is split at the matches of a pattern; the lengths of the pieces and of the matches give the
place of each match. The entropy of a window is kept in whole numbers and updated from the counts of
the character that enters and of the one that leaves.
"""

from __future__ import annotations

import math
import string
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sedimenta.llm.rows import packed, unpacked
from sedimenta.llm.words import let, whole

# The base patterns. A match of ``ASSIGN`` counts when its value has 8 characters; the
# other two state their least length themselves, which changes no match: what they take ends with a
# run of characters, and no later start in that run reaches the length either.
KEYWORD = r"""(?i:password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?"""
ASSIGN = KEYWORD + r"[A-Za-z0-9+/_.=-]+"
ASSIGN_VALUE = "^" + KEYWORD + r"([A-Za-z0-9+/_.=-]+)$"
ACCESS = r"AKIA[A-Z0-9]{12,}"
HEX = r"(?<![0-9a-f])[0-9a-f]{32,}"
#: Kinds in the order in which spans of one start are listed.
KINDS = ("assign", "access", "hex", "entropy")

ALPHABET = string.digits + string.ascii_letters + "+/_=-"
UNIT = 1 << 20  # of entropy sums


@dataclass(frozen=True)
class Entropy:
    """Candidates are runs of at least ``window`` characters of ``ALPHABET`` with a digit.

    A window of ``window`` characters is high at ``hex_bits`` where the run has hexadecimal digits
    only, at ``mixed_bits`` otherwise. Runs that match ``allowed`` are let pass.
    """

    window: int = 20
    hex_bits: float = 3.0
    mixed_bits: float = 3.8
    allowed: tuple[str, ...] = (
        r"^[0-9+/_=-]+$",  # numbers, dates, rules of signs
        r"^[0-9a-fA-F]{8}(-[0-9a-fA-F]{4}){3}-[0-9a-fA-F]{12}$",  # UUIDs
        # Nothing but words that stand for a secret; a random run that holds one is none.
        r"(?i)^(?:(?:example|placeholder|changeme|sample|dummy|test|your|key|token|secret|password"
        r"|x{4,}+|0{4,}+)[0-9]{0,4}+[/+_=-]*+)++$",
        r"^[A-Za-z]+([/_-][A-Za-z]+)*[/_-]?[0-9]*$",  # words with signs between, as in paths
    )

    @property
    def candidate(self) -> str:
        # A run with a digit, from its first character to its last.
        run = "[A-Za-z0-9+/_=-]"
        return f"(?<!{run})(?=[A-Za-z+/_=-]*[0-9]){run}{{{self.window},}}"


SPAN = "array<struct<start:int,end:int,found:string>>"


def spans(text: Column, pattern: str) -> Column:
    """Start, end (exclusive) and string of every match, from left to right, in code points."""

    def placed(matches: Column, gaps: Column) -> Column:
        walked = F.aggregate(
            matches,
            F.struct(F.lit(0).alias("i"), F.lit(0).alias("at"), F.array().cast(SPAN).alias("out")),
            lambda s, m: let(
                s["at"] + F.length(F.get(gaps, s["i"])),
                lambda start: let(
                    start + F.length(m),
                    lambda end: F.struct(
                        (s["i"] + 1).alias("i"),
                        end.alias("at"),
                        F.array_append(
                            s["out"], F.struct(start.alias("start"), end.alias("end"), m.alias("found"))
                        ).alias("out"),
                    ),
                ),
            ),
            lambda s: s["out"],
        )
        return walked

    some = let(
        F.regexp_extract_all(text, F.lit(pattern), F.lit(0)),
        lambda matches: let(F.split(text, pattern, -1), lambda gaps: placed(matches, gaps)),
    )
    return F.when(text.rlike(pattern), some).otherwise(F.array().cast(SPAN))


def _table(values: list[int]) -> Column:
    return F.split(F.lit(",".join(map(str, values))), ",").cast("array<long>")


def high_windows(found: Column, bits: Column, window: int) -> Column:
    """First start and last end, exclusive, of the windows of a string with so many bits at least.

    A window's entropy is log2(window) minus the sum of c·log2(c) over its counts c, by ``window``.
    """
    parts = [0, *[round(UNIT * c * math.log2(c)) for c in range(1, window + 1)]]
    step = [0, *[after - before for before, after in zip(parts, parts[1:], strict=False)]]
    table = _table(step)
    place = lambda at: F.instr(F.lit(ALPHABET), F.substr(found, at, F.lit(1)))
    # Sum of c·log2(c), in units, up to which a window counts as high.
    most = (F.lit(UNIT * window) * (F.lit(math.log2(window)) - bits)).cast("long")

    def moved(s: Column, i: Column) -> Column:
        entering = place(i)
        leaving = F.when(i > window, place(i - window)).otherwise(F.lit(0))

        def counted(a: Column, b: Column) -> Column:
            dropped = F.transform(s["counts"], lambda c, k: c - F.when(k + 1 == b, 1).otherwise(0))

            def added(counts: Column) -> Column:
                total = (
                    s["total"]
                    - F.when(b > 0, F.get(table, F.get(s["counts"], b - 1))).otherwise(F.lit(0))
                    + F.get(table, F.get(counts, a - 1) + 1)
                )
                return let(
                    total,
                    lambda t: F.struct(
                        F.transform(counts, lambda c, k: c + F.when(k + 1 == a, 1).otherwise(0)).alias("counts"),
                        t.alias("total"),
                        F.when((i >= window) & (t <= most), F.coalesce(s["first"], i - window)).otherwise(s["first"]).alias("first"),
                        F.when((i >= window) & (t <= most), i).otherwise(s["last"]).alias("last"),
                    ),
                )

            return let(dropped, added)

        return let(entering, lambda a: let(leaving, lambda b: counted(a, b)))

    none = F.lit(None).cast("int")
    start = F.struct(
        F.array_repeat(F.lit(0), len(ALPHABET)).alias("counts"),
        F.lit(0).cast("long").alias("total"),
        none.alias("first"),
        none.alias("last"),
    )
    return F.aggregate(
        F.sequence(F.lit(1), F.length(found)),
        start,
        moved,
        lambda s: F.struct(s["first"].alias("first"), s["last"].alias("last")),
    )


def entropy_spans(text: Column, entropy: Entropy) -> Column:
    """From the first to the last high window of every candidate that no allow-list pattern takes."""
    allowed = F.lit("|".join(f"(?:{p})" for p in entropy.allowed))
    candidates = F.filter(spans(text, entropy.candidate), lambda s: ~F.rlike(s["found"], allowed))

    def measured(s: Column) -> Column:
        hexadecimal = F.rlike(s["found"], F.lit("^[0-9a-fA-F]+$"))
        bits = F.when(hexadecimal, F.lit(entropy.hex_bits)).otherwise(F.lit(entropy.mixed_bits))
        return let(
            high_windows(s["found"], bits, entropy.window),
            lambda w: F.struct(
                (s["start"] + w["first"]).alias("start"),
                (s["start"] + w["last"]).alias("end"),
                F.substr(s["found"], w["first"] + 1, w["last"] - w["first"]).alias("found"),
            ),
        )

    return F.filter(F.transform(candidates, measured), lambda s: s["start"].isNotNull())


def listed(kinds: list[tuple[str, Column]]) -> Column:
    """``kind:start:end`` of all spans by start, then kind as listed, with commas."""
    def named(kind: str, found: Column) -> Column:
        order = F.lit(KINDS.index(kind)).alias("kind")
        said = lambda s: F.concat_ws(":", F.lit(kind), s["start"].cast("string"), s["end"].cast("string"))
        return F.transform(found, lambda s: F.struct(s["start"].alias("start"), order, said(s).alias("said")))

    every = F.concat(*[named(kind, found) for kind, found in kinds])
    return F.array_join(F.transform(F.sort_array(every), lambda s: s["said"]), ",")


def secret_spans(docs: DataFrame, entropy: Entropy = Entropy(), text: str = "text") -> DataFrame:
    """Every input row with one column of spans for each kind: start, end, string.

    Offsets are code points, ends exclusive. Spans of one kind do not overlap; those of different
    kinds may. Null counts as empty: no spans. Texts are read whole; repeated rows get equal answers.
    Input columns named like an output are replaced.
    """
    body = whole(F.col(text))
    long_enough = F.filter(
        spans(body, ASSIGN), lambda s: F.length(F.regexp_extract(s["found"], ASSIGN_VALUE, 1)) >= 8
    )
    found = packed(
        docs,
        long_enough.alias("assign"),
        spans(body, ACCESS).alias("access"),
        spans(body, HEX).alias("hex"),
        entropy_spans(body, entropy).alias("entropy"),
    )
    return unpacked(found, **{kind: F.col(kind) for kind in KINDS})
