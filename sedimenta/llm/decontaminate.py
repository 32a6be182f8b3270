"""Benchmark decontamination: a generalised suffix automaton of the test items reads every text.

The automaton accepts every run of words of every item. Reading a text word by word it tracks the
longest run that ends at each word and that some item has, too. Where that run is as long as a
window, the words of the window are hit. The items come in blocks of a stated number of words; one
automaton of a block is all that a task holds.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sedimenta.llm.rows import packed, quoted, unpacked, written

# A-Z are lower-cased, other ASCII but 0-9 and a-z stands between words.
LETTERS = bytes(range(ord("A"), ord("Z") + 1))
KEPT = set(b"0123456789abcdefghijklmnopqrstuvwxyz") | set(range(0x80, 0x100))
NORMAL = bytes(
    c + 32 if c in LETTERS else c if c in KEPT else ord(" ") for c in range(0x100)
)


def normal_words(text: str | None) -> list[bytes]:
    """Normalised words of a text as UTF-8; null has none."""
    return [] if text is None else text.encode("utf-8", "replace").translate(NORMAL).split()


@dataclass(frozen=True)
class Limits:
    """A window has ``window`` words; a text is contaminated when hit words are at least one in ``share``."""

    window: int = 13
    share: int = 20
    block_words: int = 200_000


class ItemAutomaton:
    """Generalised suffix automaton over words, with the windows of the items marked in it."""

    def __init__(self, items: list[tuple[str, list[bytes]]], window: int) -> None:
        self.next: list[dict[bytes, int]] = [{}]
        self.link = [-1]
        self.length = [0]
        for _, words in items:
            last = 0
            for word in words:
                last = self._extend(last, word)
        #: State -> window length -> items.
        self.marks: dict[int, dict[int, set[str]]] = {}
        for item, words in items:
            self._mark(item, words, min(window, len(words)))
        self.least = min((m for marks in self.marks.values() for m in marks), default=0)
        #: Nearest state on the way to the root, itself included, that has marks; 0 for none.
        self.marked = [0] * len(self.next)
        for state in sorted(range(1, len(self.next)), key=self.length.__getitem__):
            self.marked[state] = state if state in self.marks else self.marked[self.link[state]]

    def _state(self, length: int, link: int, next_: dict[bytes, int]) -> int:
        self.next.append(next_)
        self.link.append(link)
        self.length.append(length)
        return len(self.next) - 1

    def _split(self, state: int, word: bytes, target: int) -> int:
        """A state for the shorter runs of ``target``, which ``state`` and its suffixes lead to."""
        copy = self._state(self.length[state] + 1, self.link[target], dict(self.next[target]))
        self.link[target] = copy
        while state >= 0 and self.next[state].get(word) == target:
            self.next[state][word] = copy
            state = self.link[state]
        return copy

    def _extend(self, last: int, word: bytes) -> int:
        known = self.next[last].get(word)
        if known is not None:
            if self.length[known] == self.length[last] + 1:
                return known
            return self._split(last, word, known)
        new = self._state(self.length[last] + 1, 0, {})
        state = last
        while state >= 0 and word not in self.next[state]:
            self.next[state][word] = new
            state = self.link[state]
        if state >= 0:
            target = self.next[state][word]
            exact = self.length[target] == self.length[state] + 1
            self.link[new] = target if exact else self._split(state, word, target)
        return new

    def _mark(self, item: str, words: list[bytes], window: int) -> None:
        if not window:
            return
        state = 0
        for n, word in enumerate(words, 1):
            state = self.next[state][word]
            while self.length[self.link[state]] >= window:
                state = self.link[state]
            if n >= window:
                self.marks.setdefault(state, {}).setdefault(window, set()).add(item)

    def read(self, words: list[bytes]) -> tuple[list[list[int]], set[str]]:
        """Spans of hit words, first and last, and the items with occurring windows."""
        spans: list[list[int]] = []
        found: set[str] = set()
        if not self.least:
            return spans, found
        next_, link, length, marked, marks = self.next, self.link, self.length, self.marked, self.marks
        first, least = next_[0], self.least
        state = run = 0
        for place, word in enumerate(words):
            start = first.get(word)
            if start is None:
                state = run = 0
                continue
            if not state:
                state, run = start, 1
            else:
                step = next_[state].get(word)
                if step is not None:
                    run += 1
                else:
                    while step is None:
                        state = link[state]
                        step = next_[state].get(word)
                    run = length[state] + 1
                state = step
            if run < least:
                continue
            longest = 0
            at = marked[state]
            while at:
                for window, items in marks[at].items():
                    if window <= run:
                        found |= items
                        longest = max(longest, window)
                at = marked[link[at]]
            if longest:
                begin = place - longest + 1
                while spans and spans[-1][0] >= begin:
                    spans.pop()
                if spans and spans[-1][1] >= begin - 1:
                    spans[-1][1] = place
                else:
                    spans.append([begin, place])
        return spans, found


def joined(spans: list[list[int]]) -> list[list[int]]:
    """Spans in order, overlapping and adjoining ones as one."""
    out: list[list[int]] = []
    for begin, end in sorted(spans):
        if out and out[-1][1] >= begin - 1:
            out[-1][1] = max(out[-1][1], end)
        else:
            out.append([begin, end])
    return out


def without(text: str, spans: list[list[int]]) -> str:
    """The text without the words of the spans and what stands between them."""
    raw = text.encode("utf-8", "replace")
    shape = raw.translate(NORMAL)
    starts, ends, at = [], [], 0
    for word in shape.split():
        at = shape.index(word, at)
        starts.append(at)
        at += len(word)
        ends.append(at)
    kept, at = [], 0
    for begin, end in spans:
        kept.append(raw[at : starts[begin]])
        at = ends[end]
    return b"".join([*kept, raw[at:]]).decode("utf-8", "replace")


def item_blocks(items: DataFrame, limits: Limits, item: str, text: str) -> Iterator[list[tuple]]:
    """Items in blocks of about ``block_words`` words, each read by itself."""
    words = F.size(F.split(F.coalesce(quoted(text), F.lit("")), r"\s+"))
    total = items.agg(F.sum(words)).first()[0] or 0
    blocks = -(-total // limits.block_words)
    block = F.pmod(F.xxhash64(quoted(item), quoted(text)), F.lit(max(blocks, 1)))
    for number in range(blocks):
        rows = items.where(block == number).select(quoted(item).cast("string"), quoted(text)).collect()
        yield [(name or "", normal_words(body)) for name, body in rows]


def _reader(block, window: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """Adds what one block of items finds to ``n_words``, ``spans`` and ``items``."""

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        automaton = ItemAutomaton(block.value, window)
        for batch in batches:
            counts, spans, items = [], [], []
            earlier = zip(
                batch.column("text").to_pylist(),
                batch.column("spans").to_pylist(),
                batch.column("items").to_pylist(),
                strict=True,
            )
            for text, known_spans, known_items in earlier:
                words = normal_words(text)
                hit, found = automaton.read(words)
                counts.append(len(words))
                spans.append(joined(known_spans + hit) if hit else known_spans)
                items.append(sorted(found.union(known_items)) if found else known_items)
            schema = batch.schema
            new = {
                "n_words": pa.array(counts, schema.field("n_words").type),
                "spans": pa.array(spans, schema.field("spans").type),
                "items": pa.array(items, schema.field("items").type),
            }
            columns = [new.get(name, batch.column(name)) for name in schema.names]
            yield pa.RecordBatch.from_arrays(columns, schema=schema)

    return read


def decontaminate(
    docs: DataFrame,
    items: DataFrame,
    limits: Limits = Limits(),
    text: str = "text",
    item: str = "item_id",
    item_text: str = "text",
) -> DataFrame:
    """Every input row with what the items share with it.

    New columns: ``n_words``; ``n_hit``, words inside any occurrence of a window; ``spans``, their
    first and last word; ``items``, ids as strings in order, each once (a null id is an empty one);
    ``contaminated``. An item shorter than a window is a window; one without words is none. A null
    or empty text has no words and is clean; repeated rows get equal answers; texts are read whole.
    Without items every row is clean. Input columns named like an output are replaced.
    """
    spark = docs.sparkSession
    kept = [quoted(c) for c in docs.columns]
    marked = packed(
        docs.select(*kept),
        F.col(text).alias("text"),
        F.lit(0).cast("long").alias("n_words"),
        F.array().cast("array<array<int>>").alias("spans"),
        F.array().cast("array<string>").alias("items"),
    )
    marked = marked.withColumn("r", F.col("r").dropFields(text)) if len(docs.columns) > 1 else marked
    read_once = False
    for block in [*item_blocks(items, limits, item, item_text)] or [[]]:
        if read_once:
            marked = written(marked, "hits")
        marked = marked.mapInArrow(_reader(spark.sparkContext.broadcast(block), limits.window), marked.schema)
        read_once = True
    hit = F.aggregate("spans", F.lit(0).cast("long"), lambda n, s: n + (s[1] - s[0] + 1))
    counted = marked.withColumn("n_hit", hit)
    return unpacked(
        counted,
        **{text: F.col("text")},
        n_words=F.col("n_words"),
        n_hit=F.col("n_hit"),
        spans=F.col("spans"),
        items=F.col("items"),
        contaminated=(F.col("n_hit") > 0) & (limits.share * F.col("n_hit") >= F.col("n_words")),
    )


def cut(judged: DataFrame, text: str = "text") -> DataFrame:
    """``clean_text`` beside each row of ``decontaminate``: its text without the hit spans."""

    def cut_batch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            clean = [
                without(body, spans) if spans else body
                for body, spans in zip(
                    batch.column(text).to_pylist(), batch.column("spans").to_pylist(), strict=True
                )
            ]
            kept = [batch.column(n) for n in batch.schema.names if n != "clean_text"]
            names = [n for n in batch.schema.names if n != "clean_text"] + ["clean_text"]
            yield pa.RecordBatch.from_arrays([*kept, pa.array(clean, pa.string())], names)

    rest = judged.drop("clean_text")
    return judged.mapInArrow(cut_batch, T.StructType([*rest.schema.fields, T.StructField("clean_text", T.StringType())]))
