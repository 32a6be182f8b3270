"""Language identification by rank order: the out-of-place distance of n-gram profiles.

A profile lists the most frequent n-grams of letters of a language in order. The most frequent
n-grams of a text are compared with each profile: every n-gram adds the number of places between
its two ranks, one that the profile does not have adds the length of a profile. The language with
the least sum is the answer.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterator
from dataclasses import dataclass
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sedimenta.llm.ranked import first_rows
from sedimenta.llm.rows import packed, unpacked, written

#: Answer for texts without a letter.
UNKNOWN = "und"
_EDGE = 32  # stands before, between and behind words
_BITS = 21  # of one code point; three fill a number


@dataclass(frozen=True)
class Profiles:
    """Parameters.

    ranks      n-grams of a profile, and of a text that are compared
    languages  more languages than this are refused: the profiles of all are in every task
    chunk      code points that are counted at a time
    """

    ranks: int = 400
    languages: int = 1000
    chunk: int = 1_000_000


@cache
def _letters() -> np.ndarray:
    """Whether each code point is a letter."""
    return np.fromiter((chr(c).isalpha() for c in range(0x110000)), bool, 0x110000)


def letters(text: str) -> np.ndarray:
    """Code points of the lower-cased words, runs of letters, with an edge before each."""
    points = np.frombuffer(text.lower().encode("utf-32-le", "surrogatepass"), np.uint32)
    points = np.where(_letters()[points], points, _EDGE)
    points = np.append(_EDGE, points)
    return points[np.append(points[1:] != _EDGE, False) | (points != _EDGE)].astype(np.uint64)


def grams(points: np.ndarray) -> np.ndarray:
    """All runs of one to three code points that hold a letter and no edge inside, as numbers."""
    points = np.append(points, np.uint64(_EDGE))
    word, bits = points != _EDGE, np.uint64(_BITS)
    two = points[:-1] << bits | points[1:]
    three = two[:-1] << bits | points[2:]
    return np.concatenate((points[word], two[word[:-1] | word[1:]], three[word[1:-1]]))


def _counted(chunk: int):
    """Counts of the n-grams of each language's texts, a chunk at a time."""

    def rows(lang: str, held: list[np.ndarray]) -> pa.RecordBatch:
        gram, n = np.unique(grams(np.concatenate(held)), return_counts=True)
        columns = [pa.repeat(pa.scalar(lang), len(gram)), pa.array(gram.astype(np.int64)), pa.array(n, pa.int64())]
        return pa.RecordBatch.from_arrays(columns, ["lang", "gram", "n"])

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            held: defaultdict[str, list[np.ndarray]] = defaultdict(list)
            sizes: defaultdict[str, int] = defaultdict(int)
            for lang, text in zip(batch.column("lang").to_pylist(), batch.column("text").to_pylist(), strict=True):
                points = letters(text)
                if len(points):
                    held[lang].append(points)
                    sizes[lang] += len(points)
                if sizes[lang] >= chunk:
                    yield rows(lang, held.pop(lang))
                    sizes[lang] = 0
            for lang, points in held.items():
                yield rows(lang, points)

    return count


def fit(
    docs: DataFrame, learn: Column, params: Profiles = Profiles(), lang: str = "lang", text: str = "text"
) -> DataFrame:
    """lang, rank (from 1), gram: the profile of each language, counted over all rows where ``learn``.

    Rows without a language, a text or a letter teach nothing; repeated rows count as often as they
    come. Equal counts rank by n-gram.
    """
    known = docs.where(learn & F.col(lang).isNotNull() & F.col(text).isNotNull())
    given = known.select(F.col(lang).cast("string").alias("lang"), F.col(text).alias("text"))
    counts = given.mapInArrow(_counted(params.chunk), "lang string, gram long, n long")
    sums = counts.groupBy("lang", "gram").agg(F.sum("n").alias("n"))
    order = [F.col("n").desc(), F.col("gram")]
    return written(first_rows(sums, "lang", order, params.ranks, F.col("gram")).select("lang", "rank", "gram"), "profiles")


class _Judge:
    """The profiles of all languages as one table: a row for an n-gram, a column for a language."""

    def __init__(self, profiles: list[tuple[str, int, int]], ranks: int) -> None:
        self.most = ranks
        self.languages = sorted({lang for lang, _, _ in profiles})
        column = {lang: i for i, lang in enumerate(self.languages)}
        self.grams = np.unique(np.array([gram for _, _, gram in profiles], np.uint64))
        self.ranks = np.full((len(self.grams), len(column)), ranks, np.int64)
        for lang, rank, gram in profiles:
            self.ranks[np.searchsorted(self.grams, np.uint64(gram)), column[lang]] = rank - 1

    def __call__(self, text: str | None) -> tuple[str, float]:
        points = letters(text or "")
        if not len(points) or not self.languages:
            return UNKNOWN, 0.0
        found, n = np.unique(grams(points), return_counts=True)
        own = found[np.argsort(-n, kind="stable")[: self.most]]
        place = np.minimum(np.searchsorted(self.grams, own), len(self.grams) - 1)
        ranks = np.where((self.grams[place] == own)[:, None], self.ranks[place], self.most)
        away = np.abs(ranks - np.arange(len(own))[:, None])
        distances = np.where(ranks == self.most, self.most, away).sum(axis=0)
        best = int(distances.argmin())
        others = np.delete(distances, best)
        next_ = int(others.min()) if len(others) else self.most * len(own)
        return self.languages[best], 1 - int(distances[best]) / next_ if next_ else 0.0


def identify(
    docs: DataFrame, profiles: DataFrame, params: Profiles = Profiles(), text: str = "text"
) -> DataFrame:
    """Every input row with ``lang_pred`` and ``score``, how far the next language is behind (0 to 1).

    Nothing but the text is looked at, and all of it. Null texts, texts without a letter, and all
    texts where there is no profile, are ``und`` with score 0; equal distances go to the first
    language by name with score 0; with one language the score measures against the largest
    distance. Repeated rows get equal answers. Input columns named like an output are replaced.
    """
    spark = docs.sparkSession
    known = profiles.select("lang").distinct().count()
    if known > params.languages:
        raise ValueError(f"{known} languages, more than the {params.languages} that a task may hold")
    # At most params.languages * params.ranks rows.
    rows = [tuple(r) for r in profiles.select("lang", "rank", "gram").collect()]
    sent = spark.sparkContext.broadcast(rows)

    def judge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        judge_one = _Judge(sent.value, params.ranks)
        for batch in batches:
            answers = [judge_one(t) for t in batch.column("text").to_pylist()]
            found, scores = (list(c) for c in zip(*answers)) if answers else ([], [])
            columns = [batch.column("r"), pa.array(found, pa.string()), pa.array(scores, pa.float64())]
            yield pa.RecordBatch.from_arrays(columns, ["r", "lang_pred", "score"])

    given = packed(docs, F.col(text).alias("text"))
    new = [T.StructField("lang_pred", T.StringType()), T.StructField("score", T.DoubleType())]
    judged = given.mapInArrow(judge, T.StructType([given.schema["r"], *new]))
    return unpacked(judged, lang_pred=F.col("lang_pred"), score=F.col("score"))
