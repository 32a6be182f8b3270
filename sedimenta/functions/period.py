"""Year and month of a landing file, taken from its path."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column
from pyspark.sql import functions as F

# Default pattern: YYYY-MM as a whole number pair in the path part that ends in ".parquet", or,
# if there is none in such a part, in a folder. A dated folder above a dated file, or the random
# digits in the name of a part file, are not taken for the period.
_MONTH = r"(?<!\d)(\d{4})-(0[1-9]|1[0-2])(?![0-9A-Za-z])"
_LATER = r"(?<!\d)\d{4}-(?:0[1-9]|1[0-2])(?![0-9A-Za-z])[^/]*\.parquet"
PERIOD_IN_PATH = _MONTH + r"(?:[^/]*\.parquet|(?=[^/]*/(?!.*" + _LATER + ")))"

# Fixed value: leftmost YYYY-MM anywhere in the path.
LEFTMOST_PERIOD = r"(\d{4})-(\d{2})"


@dataclass(frozen=True)
class PeriodSlice:
    """Where the year and the month text stand in a path, in bytes.

    ``segment`` 0 is the whole path, 1 its last part between slashes, 2 the one before, and so on.
    ``at`` counts from the start of that, from 1, or if negative from its end, from -1.
    """

    year_segment: int
    year_at: int
    year_len: int
    month_segment: int
    month_at: int
    month_len: int


#: Three ways to say where the period stands, the cheapest for each row first: from the start of the
#: path, from the start of a part counted from the path's end, from the end of such a part. Folders of
#: any depth share the second, and names that begin in different ways the third.
ANCHORS = ("path", "start", "end")


def _match(path: Column, pattern: str) -> tuple[Column, Column]:
    return F.regexp_extract(path, pattern, 1), F.regexp_extract(path, pattern, 2)


def period_of(path: Column, pattern: str = PERIOD_IN_PATH) -> tuple[Column, Column]:
    """(year, month) of a path by pattern; NULL where it does not match."""
    year, month = _match(path, pattern)
    return year.try_cast("int"), month.try_cast("int")


def slice_of(path: Column, pattern: str = PERIOD_IN_PATH, anchor: str = "path") -> Column:
    """Where the pattern finds year and month in a path: the fields of PeriodSlice."""
    if anchor not in ANCHORS:
        raise ValueError(f"anchor {anchor!r}: expected one of {', '.join(ANCHORS)}")
    texts = _match(path, pattern)
    found_at = F.regexp_instr(path, F.lit(pattern))
    year_at = F.position(texts[0], path, found_at)
    # Month behind the year if it is there: in 2001-01 the first "01" belongs to the year.
    behind = F.position(texts[1], path, year_at + F.length(texts[0]))
    month_at = F.when(behind > 0, behind).otherwise(F.position(texts[1], path, found_at))

    def place(char_at: Column) -> tuple[Column, Column]:
        before = F.substr(path, F.lit(1), char_at - 1)
        rest = F.substr(path, char_at)
        if anchor == "path":
            return F.lit(0), F.octet_length(before) + 1
        segment = F.length(rest) - F.length(F.replace(rest, F.lit("/"), F.lit(""))) + 1
        if anchor == "start":
            return segment, F.octet_length(F.substring_index(before, "/", -1)) + 1
        return segment, -F.octet_length(F.substring_index(rest, "/", 1))

    fields = []
    for name, char_at, text in (("year", year_at, texts[0]), ("month", month_at, texts[1])):
        segment, at = place(char_at)
        fields += [
            segment.alias(f"{name}_segment"),
            at.alias(f"{name}_at"),
            F.octet_length(text).alias(f"{name}_len"),
        ]
    return F.struct(*fields)


def period_by_slice(path: Column, at: PeriodSlice) -> tuple[Column, Column]:
    """(year, month) cut out of the path bytes.

    Same result as :func:`period_of` for paths that share one PeriodSlice, at a fraction of the
    cost per row: no pattern matching, and from the start of the path no decoding either.
    """

    def number(segment: int, start: int, length: int) -> Column:
        part = F.substring_index(path, "/", -segment) if segment else path
        if segment > 1 and start < 0:
            part = F.substring_index(part, "/", 1)
        return F.substring(part.cast("binary"), start, length).cast("string").try_cast("int")

    return (
        number(at.year_segment, at.year_at, at.year_len),
        number(at.month_segment, at.month_at, at.month_len),
    )


@dataclass(frozen=True)
class PeriodRange:
    """Closed range of months; ``PeriodRange((2023, 1), (2023, 5))``."""

    first: tuple[int, int]
    last: tuple[int, int]

    def __post_init__(self) -> None:
        months_fit = all(1 <= month <= 12 for _, month in (self.first, self.last))
        if self.first > self.last or not months_fit:
            raise ValueError(f"no range of months: {self.first} to {self.last}")

    def has(self, year: int, month: int) -> bool:
        return self.first <= (year, month) <= self.last

    def holds(self, year: Column, month: Column) -> Column:
        """Row test built from plain comparisons, so it prunes partitions."""
        (y0, m0), (y1, m1) = self.first, self.last
        return (
            year.between(y0, y1)
            & ((year > y0) | (month >= m0))
            & ((year < y1) | (month <= m1))
        )


@dataclass(frozen=True)
class MonthSet:
    """Some months, not all of a range."""

    months: frozenset[tuple[int, int]]

    def has(self, year: int, month: int) -> bool:
        return (year, month) in self.months

    def holds(self, year: Column, month: Column) -> Column:
        """Row test built from plain comparisons, so it prunes partitions; false for no month."""
        found = F.lit(False)
        for y in sorted({y for y, _ in self.months}):
            found = found | ((year == y) & month.isin([m for of, m in sorted(self.months) if of == y]))
        return found


#: Months that a load, a read or a write is limited to.
Period = PeriodRange | MonthSet
