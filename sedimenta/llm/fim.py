"""Fill-in-middle: texts cut in three by units, in the order that a model is to see them.

A batch goes through pyarrow.compute as columns: texts become lists of units, the lists one flat
array with the parent and the ordinal of each unit, a filter for each role picks its units, which
become lists again and are joined. No step looks at one text alone.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sedimenta.llm.rows import packed, unpacked
from sedimenta.llm.words import whole

# Markers of the three parts.
PREFIX, SUFFIX, MIDDLE = "<P>", "<S>", "<M>"

#: A unit in UTF-8 bytes: a run of ASCII letters, or one other code point.
UNIT = rb"[A-Za-z]+|[\x00-\x7F]|[\xC0-\xFF][\x80-\xBF]*"
#: A byte that no UTF-8 text has; it ends each unit.
END = b"\xff"


@dataclass(frozen=True)
class FillInMiddle:
    """Parameters.

    plain_percent  so many of a hundred texts stay as they are
    spm_percent    of the others so many of a hundred show the suffix first
    seed           another seed draws other cuts
    chunk_bytes    text that is worked on at a time; one longer text is a chunk of its own
    """

    plain_percent: int = 10
    spm_percent: int = 20
    seed: int = 1
    chunk_bytes: int = 4 << 20


def draws(id_: Column, seed: int) -> Column:
    """Four numbers below 2³² that the id and the seed decide; a null id counts as empty text."""
    named = F.concat(F.lit(f"{seed}:"), whole(id_.cast("string")))
    digest = F.sha2(named.cast("binary"), 256)
    return F.array(*[F.conv(F.substring(digest, 1 + 8 * i, 8), 16, 10).cast("long") for i in range(4)])


def _modulo(value: pa.Array, by: pa.Array | int) -> pa.Array:
    return pc.subtract(value, pc.multiply(pc.divide(value, by), by))


def _part(units: pa.Array, inside: pa.Array, lengths: pa.Array) -> pa.Array:
    """The units of one role as a text for each parent; ``lengths`` says how many each has."""
    ends = pc.cumulative_sum(lengths)
    offsets = pa.concat_arrays([pa.array([0], pa.int64()), ends])
    lists = pa.LargeListArray.from_arrays(offsets, units.filter(inside))
    return pc.binary_join(lists, b"")


def cut(texts: pa.Array, draws: pa.Array, plain_percent: int, spm_percent: int) -> list[pa.Array]:
    """Units, form, parts and output of each text (binary, no nulls); ``draws``: four numbers each."""
    h1, h2, h3, h4 = (pc.list_element(draws, i) for i in range(4))
    pieces = pc.split_pattern(pc.replace_substring_regex(texts, UNIT, rb"\0" + END), END)
    n = pc.subtract(pc.cast(pc.list_value_length(pieces), pa.int64()), 1)  # behind the last end is nothing
    one, other = (_modulo(h, pc.add(n, 1)) for h in (h1, h2))
    first, second = pc.min_element_wise(one, other), pc.max_element_wise(one, other)

    units, parent = pc.list_flatten(pieces), pc.list_parent_indices(pieces)
    starts = pc.subtract(pc.cumulative_sum(pc.add(n, 1)), pc.add(n, 1))
    ordinal = pc.subtract(pa.array(np.arange(len(units))), starts.take(parent))
    before, behind = pc.less(ordinal, first.take(parent)), pc.greater_equal(ordinal, second.take(parent))
    inner = pc.invert(pc.or_(before, behind))
    prefix = _part(units, before, first)
    middle = _part(units, inner, pc.subtract(second, first))
    suffix = _part(units, behind, pc.add(pc.subtract(n, second), 1))

    marked = pc.match_substring_regex(texts, f"{PREFIX}|{SUFFIX}|{MIDDLE}")
    plain = pc.or_(
        pc.or_(pc.equal(n, 0), marked), pc.greater_equal(_modulo(h3, 100), 100 - plain_percent)
    )
    spm = pc.less(_modulo(h4, 100), spm_percent)
    form = pc.if_else(plain, "plain", pc.if_else(spm, "spm", "psm"))
    p, s, m = (pa.scalar(marker.encode(), pa.binary()) for marker in (PREFIX, SUFFIX, MIDDLE))
    none = pa.scalar(b"", pa.binary())
    psm = pc.binary_join_element_wise(p, prefix, s, suffix, m, middle, none)
    suffix_first = pc.binary_join_element_wise(s, suffix, p, prefix, m, middle, none)
    output = pc.if_else(plain, texts, pc.if_else(spm, suffix_first, psm))
    parts = [pc.if_else(plain, pa.scalar(None, pa.binary()), part) for part in (prefix, middle, suffix)]
    return [n, form, *parts, output]


def _chunks(lengths: np.ndarray, most: int) -> Iterator[tuple[int, int]]:
    """Runs of rows (first, number) of at most ``most`` bytes, or of one longer text."""
    start, held = 0, 0
    for row, length in enumerate(lengths):
        if row > start and held + length > most:
            yield start, row - start
            start, held = row, 0
        held += length
    if start < len(lengths):
        yield start, len(lengths) - start


_NEW = T.StructType(
    [T.StructField("n", T.LongType())]
    + [T.StructField(c, T.StringType()) for c in ("form", "prefix", "middle", "suffix", "output")]
)


def _batches(params: FillInMiddle):
    def transform(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lengths = pc.binary_length(batch.column("text")).to_numpy(zero_copy_only=False)
            for start, number in _chunks(lengths, params.chunk_bytes):
                chunk = batch.slice(start, number)
                texts = pc.cast(chunk.column("text"), pa.binary())
                n, form, *rest = cut(texts, chunk.column("draws"), params.plain_percent, params.spm_percent)
                columns = [chunk.column("r"), n, form, *(c.cast(pa.string(), safe=False) for c in rest)]
                yield pa.RecordBatch.from_arrays(columns, ["r", *_NEW.names])

    return transform


def fill_in_middle(
    docs: DataFrame, params: FillInMiddle = FillInMiddle(), id_: str = "doc_id", text: str = "text"
) -> DataFrame:
    """Every input row with ``n`` units, ``form``, ``prefix``, ``middle``, ``suffix`` and ``output``.

    ``form`` is ``plain`` (output is the text; the parts are null), ``psm`` or ``spm``. A null text
    counts as empty; empty texts, and texts that hold a marker, are plain. The id and the seed
    decide the cuts, so repeated rows get equal answers; rows with a null id share one draw. Texts
    are cut whole, however long. Input columns named like an output are replaced.
    """
    given = packed(docs, whole(F.col(text)).alias("text"), draws(F.col(id_), params.seed).alias("draws"))
    row = T.StructType([given.schema["r"], *_NEW.fields])
    made = given.mapInArrow(_batches(params), row)
    return unpacked(made, **{name: F.col(name) for name in _NEW.names})


def restored(output: Column, form: Column) -> Column:
    """The text again, from output and form alone: a marker stands in a cut text once, as itself."""
    parts = F.split(output, f"{PREFIX}|{SUFFIX}|{MIDDLE}")
    one, two, middle = (F.get(parts, F.lit(i)) for i in (1, 2, 3))
    return (
        F.when(form == "plain", output)
        .when(form == "psm", F.concat(one, middle, two))
        .when(form == "spm", F.concat(two, middle, one))
    )
