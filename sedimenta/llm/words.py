"""Words and hashed n-grams as column expressions."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

# The characters between words.
BLANKS = " \t\n\x0b\f\r"
BLANK_PATTERN = r"[\x20\x09-\x0D]+"


def whole(text: Column) -> Column:
    """The text; null counts as empty."""
    return F.coalesce(text, F.lit(""))


def words(text: Column) -> Column:
    """Maximal runs of non-blank characters, in order; none in a null or blank text."""
    trimmed = F.btrim(whole(text), F.lit(BLANKS))
    none = F.array().cast("array<string>")
    return F.when(trimmed == "", none).otherwise(F.split(trimmed, BLANK_PATTERN))


def word_hashes(word_list: Column) -> Column:
    return F.transform(word_list, lambda w: F.xxhash64(w))


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of a value that is worked out once, however often the body names it.

    A plain column named inside a lambda is worked out again for every element.
    """
    return F.get(F.transform(F.array(value), body), F.lit(0))


def windows(hashes: Column, width: int) -> Column:
    """Hash of every run of ``width`` consecutive words; none in a shorter text.

    ``hashes`` is bound by ``let`` or a lambda.
    """
    runs = F.transform(
        hashes, lambda h, i: F.xxhash64(h, *[F.get(hashes, i + k) for k in range(1, width)])
    )
    return F.slice(runs, F.lit(1), F.greatest(F.size(hashes) - (width - 1), F.lit(0)))


def grams(hashes: Column) -> Column:
    """Hashes of all single words and of all pairs of neighbours."""
    return let(hashes, lambda h: F.concat(h, windows(h, 2)))
