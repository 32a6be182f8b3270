"""Substring dedup by sliding sentence spans.

A span is a run of consecutive sentences with enough words. Every sentence begins one span and ends
another, each as short as the limit allows, so a repeated passage of twice the limit is covered
whatever stands before and after it. Spans are joined by hash over all documents; sentences inside a
span that an earlier place has already are removed.

Passages without such a span, of few or long or cut sentences, are found by their words: every window
of twice the limit that holds no repeated span is joined as well, and loses its words. Only windows
that can repeat are made: of the runs of half a window inside it, the one with the least hash repeats.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sedimenta.llm.rows import field, staged, unpacked, written
from sedimenta.llm.shingles import mixed

#: A sentence ends with its stops and what closes it, before a blank, or with its line.
SENTENCE_END = re.compile(r"[.!?][\"'»”)\]]*\s+|\n\s*")


#: Sets hashes of words apart from those of sentences.
WORDS = 0xD6E8FEB86659FD93


@dataclass(frozen=True)
class SentenceSpans:
    """Parameters.

    words      a span has at least so many words
    sentences  and at least so many sentences, or else twice the words; windows have twice the words
    """

    words: int = 25
    sentences: int = 2


def sentences(text: str | None) -> list[tuple[int, int]]:
    """Start and end of each sentence with the blanks after it; together they are the whole text."""
    if not text:
        return []
    ends = [found.end() for found in SENTENCE_END.finditer(text)]
    if not ends or ends[-1] < len(text):
        ends.append(len(text))
    return list(zip([0, *ends], ends))


def spans_of(counts: np.ndarray, params: SentenceSpans) -> np.ndarray:
    """First and last sentence of every span, each once, from the words of each sentence."""
    n = len(counts)
    if not n:
        return np.empty((0, 2), np.int64)
    sums = np.concatenate([[0], np.cumsum(counts)])
    place = np.arange(n)
    forth = np.searchsorted(sums, sums[:-1] + params.words) - 1  # the sentence that reaches the limit
    alone = counts >= 2 * params.words
    forth = np.where(alone, place, np.maximum(forth, place + params.sentences - 1))
    back = np.searchsorted(sums, sums[1:] - params.words, side="right") - 1
    back = np.where(alone, place, np.minimum(back, place - params.sentences + 1))
    pairs = np.unique(np.concatenate([(place * n + forth)[forth < n], (back * n + place)[back >= 0]]))
    return np.stack([pairs // n, pairs % n], 1)


#: The base of the polynomial, its inverse, and a number for each byte.
BASE = 0x9E3779B97F4A7C15
INVERSE = pow(BASE, -1, 1 << 64)
BYTES = mixed(np.arange(1, 257, dtype=np.uint64))


@lru_cache(maxsize=64)
def powers(base: int, size: int) -> np.ndarray:
    """``base`` to the power 0 up to ``size``, modulo 2^64."""
    out = np.ones(size + 1, np.uint64)
    np.multiply.accumulate(np.full(size, base, np.uint64), out=out[1:])
    return out


def span_hashes(hashes: np.ndarray, spans: np.ndarray) -> np.ndarray:
    """A hash of the sentences of each span, by prefix sums of a polynomial modulo 2^64."""
    n = len(hashes)
    size = 1 << max(14, n.bit_length())  # few sizes, so that the powers are kept
    forth, back = powers(BASE, size), powers(INVERSE, size)
    sums = np.zeros(n + 1, np.uint64)
    np.cumsum(hashes * forth[:n], dtype=np.uint64, out=sums[1:])
    first, last = spans[:, 0], spans[:, 1]
    inner = (sums[last + 1] - sums[first]) * back[first]
    return mixed(inner ^ ((last - first + 1).astype(np.uint64) * np.uint64(BASE)))


def parsed(text: str, parts: list[tuple[int, int]]) -> tuple[list[str], np.ndarray]:
    """All words of a text, and how many stand before each sentence and before the end."""
    words, ends = [], [0]
    for a, b in parts:
        words += text[a:b].split()
        ends.append(len(words))
    return words, np.array(ends)


def word_values(words: list[str]) -> np.ndarray:
    """A hash of each word: that of the run of its bytes, in all words with one blank after each."""
    letters = np.frombuffer((" ".join(words) + " ").encode("utf-8", "replace"), np.uint8)
    blanks = np.flatnonzero(letters == 32) if words else np.empty(0, np.int64)
    return span_hashes(BYTES[letters], np.stack([np.concatenate([[0], blanks + 1])[:-1], blanks - 1], 1))


def runs(n: int, width: int) -> np.ndarray:
    """First and last of every run of ``width`` out of ``n``, at least one."""
    first = np.arange(n - width + 1)
    return np.stack([first, first + width - 1], 1)


def least_places(hashes: np.ndarray, width: int) -> np.ndarray:
    """Place of the first least one of ``width`` neighbours, from each place on."""
    at, span = np.arange(len(hashes)), 1
    while span < width:
        step = min(span, width - span)
        one, other = at[:-step], at[step:]
        at, span = np.where(hashes[one] <= hashes[other], one, other), span + step
    return at


def least_runs(values: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all runs of ``width`` words; place of the least one in each window of twice as many."""
    if len(values) < 2 * width:
        return np.empty(0, np.uint64), np.empty(0, np.int64)
    hashes = span_hashes(values, runs(len(values), width))
    return hashes, least_places(hashes, width + 1)


def within(size: int, low: np.ndarray, high: np.ndarray) -> np.ndarray:
    """Which of ``size`` places are in one of the ranges from ``low`` up to before ``high``."""
    some = low < high
    steps = np.bincount(low[some], minlength=size + 1) - np.bincount(high[some], minlength=size + 1)
    return np.cumsum(steps[:size]) > 0


def window_places(least: np.ndarray, width: int, repeated: np.ndarray, covered: np.ndarray) -> np.ndarray:
    """First words of the windows of ``2 * width`` whose least run repeats and that hold no ``covered`` words.

    ``least``: place of the least run of every window. Equal windows have theirs at the same place.
    """
    if not len(least) or not len(repeated):
        return np.empty(0, np.int64)
    hold = within(len(least), np.maximum(covered[:, 1] - 2 * width, 0), np.minimum(covered[:, 0] + 1, len(least)))
    known = np.zeros(len(least) + width, bool)
    known[repeated] = True
    return np.flatnonzero(known[least] & ~hold)


def lists(column: pa.Array) -> Iterator[np.ndarray]:
    """The list of each row as an array; null counts as empty, structs become rows of their fields."""
    values = column.flatten()
    if pa.types.is_struct(values.type):
        flat = np.stack([field.to_numpy() for field in values.flatten()], 1).astype(np.int64)
    else:
        flat = values.to_numpy().astype(np.int64)
    ends = np.cumsum(pc.fill_null(pc.list_value_length(column), 0).to_numpy())
    return iter(np.split(flat, ends[:-1]) if len(column) else [])


def _hashed(params: SentenceSpans):
    def hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            of, firsts, lasts, keys = [], [], [], []
            for i, text in enumerate(batch.column("text").to_pylist()):
                if not text:
                    continue
                words, ends = parsed(text, sentences(text))
                values = word_values(words)
                runs_of, least = least_runs(values, params.words)
                places = np.unique(least)
                spans = spans_of(np.diff(ends), params)
                sentence_values = span_hashes(values, np.stack([ends[:-1], ends[1:] - 1], 1))
                keys += [mixed(runs_of[places] ^ np.uint64(WORDS)), span_hashes(sentence_values, spans)]
                of.append(np.full(len(places) + len(spans), i, np.int32))
                firsts += [places, spans[:, 0]]
                lasts += [np.full(len(places), -1), spans[:, 1]]
            if of:
                of = pa.array(np.concatenate(of))
                found = [pa.array(np.concatenate(keys).view(np.int64))]
                found += [batch.column(name).take(of) for name in ("row", "id")]
                found += [pa.array(np.concatenate(c).astype(np.int32)) for c in (firsts, lasts)]
                yield pa.RecordBatch.from_arrays(found, ["key", "row", "id", "first", "last"])

    return hashed


def _windows(params: SentenceSpans):
    def windows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            of, keys, firsts = [], [], []
            given = zip(batch.column("text").to_pylist(), lists(batch.column("repeated")), lists(batch.column("spans")), strict=True)
            for i, (text, repeated, spans) in enumerate(given):
                words, ends = parsed(text, sentences(text))
                covered = np.stack([ends[spans[:, 0]], ends[spans[:, 1] + 1]], 1)
                values = word_values(words)
                places = window_places(least_runs(values, params.words)[1], params.words, repeated, covered)
                spots = np.stack([places, places + 2 * params.words - 1], 1)
                keys.append(span_hashes(values, spots))
                of.append(np.full(len(places), i, np.int32))
                firsts.append(places)
            if of:
                of = pa.array(np.concatenate(of))
                found = [pa.array(np.concatenate(keys).view(np.int64))]
                found += [batch.column(name).take(of) for name in ("row", "id")]
                found.append(pa.array(np.concatenate(firsts).astype(np.int32)))
                yield pa.RecordBatch.from_arrays(found, ["key", "row", "id", "first"])

    return windows


def without(text: str, gone: np.ndarray) -> str:
    """The text without some of its words and the blanks after them."""
    out, at = [], 0
    for found, cut in zip(re.finditer(r"\S+\s*", text), gone, strict=True):
        if cut:
            out.append(text[at : found.start()])
            at = found.end()
    return "".join(out) + text[at:]


def _cut(params: SentenceSpans):
    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        return _without_repeats(batches, 2 * params.words)

    return cut


def _without_repeats(batches: Iterator[pa.RecordBatch], width: int) -> Iterator[pa.RecordBatch]:
    """Texts without the sentences of their repeated spans and the words of their repeated windows."""
    for batch in batches:
        texts, totals, removed, gone = [], [], [], []
        given = zip(batch.column("text").to_pylist(), lists(batch.column("spans")), lists(batch.column("windows")), strict=True)
        for text, spans, windows in given:
            parts = sentences(text)
            totals.append(len(parts))
            if not len(spans) and not len(windows):
                texts.append(text)
                removed.append([])
                gone.append(0)
                continue
            ends = parsed(text, parts)[1]
            low, high = np.append(ends[spans[:, 0]], windows), np.append(ends[spans[:, 1] + 1], windows + width)
            lost = within(int(ends[-1]), low, high)
            before = np.append(0, np.cumsum(lost))
            n_lost, n_words = np.diff(before[ends]), np.diff(ends)
            out = within(len(parts), spans[:, 0], spans[:, 1] + 1) | ((n_lost == n_words) & (n_words > 0))
            left = [
                without(text[a:b], lost[ends[i] : ends[i + 1]]) if n_lost[i] else text[a:b]
                for i, (a, b) in enumerate(parts)
                if not out[i]
            ]
            texts.append("".join(left))
            removed.append(np.flatnonzero(out))
            gone.append(int(before[-1]))
        columns = {
            "clean": pa.array(texts, pa.string()),
            "n_sentences": pa.array(totals, pa.int64()),
            "removed": pa.array(removed, pa.list_(pa.int32())),
            "n_removed_words": pa.array(gone, pa.int64()),
        }
        kept = [batch.column("row"), batch.column("r")]
        yield pa.RecordBatch.from_arrays([*kept, *columns.values()], ["row", "r", *columns])


def remove_repeated_spans(
    docs: DataFrame, params: SentenceSpans = SentenceSpans(), text: str = "text", id_: str = "doc_id"
) -> DataFrame:
    """Every input row, its text without repeated spans, and what was removed.

    New columns: ``n_sentences``, ``removed`` (places of removed sentences, from 0), ``n_removed``,
    ``n_removed_words``. The first place of a span, by id (null last), then row, then place in the
    text, keeps its sentences; every other loses them. So do windows of words that hold no repeated
    span; of a sentence that is not wholly inside, the other words stay, and it is not in ``removed``.
    A window that overlaps its first place stays. Sentences are compared by their words. Null and empty texts have none and stay as they are; of repeated rows the first stays whole. Texts
    are read whole. Input columns named like an output are replaced.
    """
    rows = staged(docs, "spans-input")
    texts = rows.select("row", field(id_).alias("id"), field(text).alias("text"))
    place = f"key long, row long, id {texts.schema['id'].dataType.simpleString()}, first int"
    found = texts.mapInArrow(_hashed(params), f"{place}, last int")
    # The order of places is the order of rows here, until the few spans that repeat are known.
    spans = written(found, "spans")
    counts = spans.groupBy("key").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select("key")
    places = written(spans.join(counts, "key", "left_semi"), "repeated-spans")
    order = F.struct(F.col("id").isNull().alias("none"), "id", "row", F.col("first").alias("first"))
    sentence_places = places.where("last >= 0")
    lead = sentence_places.groupBy("key").agg(F.min(order).alias("lead"))
    later = sentence_places.join(lead, "key").where((F.col("row") != F.col("lead.row")) | (F.col("first") != F.col("lead.first")))
    # At most two spans for each sentence of a text, each once, and fewer windows than words.
    span = F.struct("first", "last")
    by_row = written(later.groupBy("row").agg(F.collect_list(span).alias("spans")), "later-spans")
    # Both copies of a window hold the same spans, so both have it or none.
    known = places.groupBy(F.col("row").alias("of")).agg(
        F.collect_list(F.when(F.col("last") < 0, F.col("first"))).alias("repeated"),
        F.collect_list(F.when(F.col("last") >= 0, span)).alias("spans"),
    )
    open_texts = texts.join(known.where(F.size("repeated") > 0), F.col("row") == F.col("of")).drop("of")
    windows = written(open_texts.mapInArrow(_windows(params), place), "windows")
    twice = windows.groupBy("key").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select("key")
    spots = windows.join(twice, "key", "left_semi")
    origin = spots.groupBy("key").agg(F.min(order).alias("lead"))
    again = spots.join(origin, "key").where(
        (F.col("row") != F.col("lead.row")) | (F.col("first") >= F.col("lead.first") + 2 * params.words)
    )
    cuts = written(again.groupBy(F.col("row").alias("cut")).agg(F.collect_list("first").alias("windows")), "cuts")
    matched = rows.join(by_row.withColumnRenamed("row", "hit"), F.col("row") == F.col("hit"), "left")
    matched = matched.join(cuts, F.col("row") == F.col("cut"), "left")
    given = matched.select("row", F.col("r").dropFields(text).alias("r"), field(text).alias("text"), "spans", "windows")
    schema = given.schema
    out = given.mapInArrow(
        _cut(params),
        f"row long, r {schema['r'].dataType.simpleString()}, clean string, n_sentences long, removed array<int>, n_removed_words long",
    )
    return unpacked(
        out,
        **{text: F.col("clean")},
        n_sentences=F.col("n_sentences"),
        removed=F.col("removed"),
        n_removed=F.size("removed").cast("long"),
        n_removed_words=F.col("n_removed_words"),
    )
