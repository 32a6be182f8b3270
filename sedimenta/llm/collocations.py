"""Phrases whose words stand together more often than their parts let expect.

Texts of one language become shards: word numbers in a row, cut at the ends of pieces. Each shard
has its own bidirectional FM-index, which lists its phrases with their counts; the sums over all
shards are the frequencies. A phrase is as frequent as asked for only if its words are, and its
pairs of words, so the texts are cut at rare words first and at rare pairs then, before phrases of
full length are listed: what the shards send grows with what is frequent.

Shards send their counts in blocks, one for each bucket of keys. A task adds up one bucket, and
answers every block with one bit a key. Words and phrases are their own keys. Pairs are asked by
hash: two pairs that share one can seem frequent together, which leaves text in that the last step
counts exactly, but none that is frequent is lost.
"""

from __future__ import annotations

import zlib
from collections import defaultdict
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sedimenta.llm.fmindex import phrases
from sedimenta.llm.ranked import first_rows
from sedimenta.llm.rows import written
from sedimenta.llm.shingles import mixed
from sedimenta.llm.words import whole
from sedimenta.session import session_conf

# A-Z are lower-cased, these characters end a piece, blanks and tabs stand between words.
ENDS = b".,;:!?\n\x0b\x0c\r"
BREAK = b"\xff"  # no UTF-8 text has this byte
NORMAL = bytes(
    c + 32 if ord("A") <= c <= ord("Z") else BREAK[0] if c in ENDS else c for c in range(0x100)
)
#: Language of texts without one.
UNKNOWN = "und"

#: Parts of phrases are joined in so many copies: one word may be in a third of all phrases.
COPIES = 8
#: Shards or blocks that one Arrow batch holds.
FEW_ROWS = {"spark.sql.execution.arrow.maxRecordsPerBatch": "8"}
#: Keys that a bucket holds, more or less; a key that all shards send is one of them for each.
BUCKET = 2_000_000


@dataclass(frozen=True)
class Collocations:
    """Parameters.

    least        a candidate occurs so often in its language
    longest      and has two to so many words
    most         phrases that are returned for each language
    contained    a candidate inside a longer one that has this share of its occurrences, in
                 percent, is dropped
    shard_words  words of a shard, and of one text more
    hash_bits    pairs are asked by so many bits; fewer leave more text to be counted exactly
    """

    least: int = 100
    longest: int = 5
    most: int = 2000
    contained: int = 100
    shard_words: int = 2_000_000
    hash_bits: int = 40


def _zipped(data: bytes) -> bytes:
    """Compressed, with the length in front."""
    return len(data).to_bytes(8, "little") + pa.compress(data, "zstd", asbytes=True)


def _unzipped(data: bytes) -> bytes:
    return pa.decompress(data[8:], int.from_bytes(data[:8], "little"), "zstd", asbytes=True)


def _numbers(data: bytes, kind: type) -> np.ndarray:
    return np.frombuffer(_unzipped(data), kind)


def _hashes_zipped(hashes: np.ndarray) -> bytes:
    """Hashes in order as differences, a byte of all of them after the other."""
    return _zipped(np.diff(hashes, prepend=np.uint64(0)).view(np.uint8).reshape(-1, 8).T.tobytes())


def _hashes(data: bytes) -> np.ndarray:
    steps = np.frombuffer(_unzipped(data), np.uint8).reshape(8, -1).T
    return np.cumsum(np.ascontiguousarray(steps).view(np.uint64).ravel(), dtype=np.uint64)


def _keys(data: bytes) -> list[bytes]:
    """Words or phrases of a block; none of them holds the end of a line."""
    text = _unzipped(data)
    return text.split(b"\n") if text else []


def _row(names: str, *values) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array([v]) for v in values], names.split())


class _Shard:
    """Texts of one language as numbers of words in order of first use; 0 ends a piece."""

    columns = "shard lang words kinds text keys counts"
    schema = "shard long, lang string, words long, kinds long, text binary, keys binary, counts binary"

    def __init__(self) -> None:
        self.numbers: defaultdict[bytes, int] = defaultdict()
        self.numbers.default_factory = self.numbers.__len__
        self.numbers[BREAK]
        self.texts = [np.zeros(1, np.int32)]
        self.size = 0

    def add(self, text: bytes) -> int:
        """Words of the text, ends of pieces included."""
        words = text.translate(NORMAL).replace(BREAK, b" " + BREAK + b" ").split()
        words.append(BREAK)
        self.texts.append(np.fromiter(map(self.numbers.__getitem__, words), np.int32, len(words)))
        self.size += len(words)
        return len(words)

    def row(self, shard: int, lang: str) -> pa.RecordBatch:
        text = np.concatenate(self.texts)
        counts = np.bincount(text, minlength=len(self.numbers))[1:]
        stored = (_joined_breaks(text).tobytes(), b"\n".join([*self.numbers][1:]), counts.tobytes())
        return _row(self.columns, shard, lang, int(counts.sum()), len(counts), *map(_zipped, stored))


def _joined_breaks(text: np.ndarray) -> np.ndarray:
    """The text without pieces of no word."""
    return text[np.concatenate(([True], (text[1:] != 0) | (text[:-1] != 0)))]


def _shards(shard_words: int):
    def build(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = TaskContext.get().partitionId() << 32
        held: defaultdict[str, _Shard] = defaultdict(_Shard)
        words = 0
        for batch in batches:
            texts = pc.cast(batch.column("text"), pa.binary()).to_pylist()
            for lang, text in zip(batch.column("lang").to_pylist(), texts, strict=True):
                words += held[lang].add(text)
                # A full shard goes; so do all of many languages' small ones.
                full = [lang] if held[lang].size >= shard_words else []
                for done in [*held] if words >= 2 * shard_words else full:
                    words -= held[done].size
                    yield held[done].row(number, done)
                    del held[done]
                    number += 1
        for number, (lang, shard) in enumerate(held.items(), number):
            yield shard.row(number, lang)

    return build


# Blocks: what one shard asks of one bucket.
_BLOCK = "lang bucket shard keys counts"
_BLOCK_SCHEMA = "lang string, bucket long, shard long, keys binary, counts binary"
_ANSWER_SCHEMA = "lang string, bucket long, shard long, bits binary, phrase string, f long"


def _dealt(keys: list[bytes], buckets: int) -> np.ndarray:
    """Bucket of each word or phrase."""
    return np.fromiter(map(zlib.crc32, keys), np.int64, len(keys)) % buckets


def _in_buckets(bucket: np.ndarray) -> Iterator[tuple[int, np.ndarray]]:
    """Each bucket that has keys, with their places in order."""
    order = np.argsort(bucket, kind="stable")
    starts = np.flatnonzero(np.diff(bucket[order], prepend=-1))
    for places in np.split(order, starts[1:]) if len(order) else []:
        yield int(bucket[places[0]]), places


def _ask(keys: list[bytes], counts: np.ndarray, buckets: int, lang: str, shard: int) -> Iterator[pa.RecordBatch]:
    for bucket, places in _in_buckets(_dealt(keys, buckets)):
        some = b"\n".join([keys[i] for i in places.tolist()])
        yield _row(_BLOCK, lang, bucket, shard, _zipped(some), _zipped(counts[places].tobytes()))


def _answer(least: int, bits: bool):
    """Frequent words or phrases of a bucket with their frequencies, and a bit for each key asked."""

    def add(table: pa.Table) -> pa.Table:
        blocks = [_keys(data) for data in table.column("keys").to_pylist()]
        counts = [_numbers(data, np.int64) for data in table.column("counts").to_pylist()]
        number: dict[bytes, int] = {}
        numbers = [np.fromiter((number.setdefault(k, len(number)) for k in b), np.int64, len(b)) for b in blocks]
        sums = np.zeros(len(number), np.int64)
        for places, n in zip(numbers, counts, strict=True):
            sums[places] += n  # a key stands in a block once
        often = sums >= least
        found = [(k.decode("utf-8", "replace"), int(n)) for k, n, ok in zip(number, sums, often) if ok]
        lang, bucket = table.column("lang")[0].as_py(), table.column("bucket")[0].as_py()
        rows = [(lang, None, None, None, phrase, n) for phrase, n in found]
        if bits:
            shards = table.column("shard").to_pylist()
            packed = (np.packbits(often[places]).tobytes() for places in numbers)
            rows += [(lang, bucket, s, b, None, None) for s, b in zip(shards, packed, strict=True)]
        return _answers(rows)

    return add


def _answer_hashes(least: int):
    """A bit for each hash asked."""

    def add(table: pa.Table) -> pa.Table:
        blocks = [_hashes(data) for data in table.column("keys").to_pylist()]
        kind = np.min_scalar_type(least)
        counts = np.concatenate([_numbers(data, kind) for data in table.column("counts").to_pylist()])
        _, numbers = np.unique(np.concatenate(blocks), return_inverse=True)
        often = np.bincount(numbers, weights=counts) >= least
        answers = np.split(often[numbers], np.cumsum([len(b) for b in blocks])[:-1])
        columns = (table.column(c).to_pylist() for c in ("lang", "bucket", "shard"))
        packed = (np.packbits(a).tobytes() for a in answers)
        return _answers([(lang, b, s, bits, None, None) for lang, b, s, bits in zip(*columns, packed, strict=True)])

    return add


_ANSWER = pa.schema(
    [("lang", pa.string()), ("bucket", pa.int64()), ("shard", pa.int64()), ("bits", pa.binary()), ("phrase", pa.string()), ("f", pa.int64())]
)


def _answers(rows: list[tuple]) -> pa.Table:
    columns = zip(*rows) if rows else [[] for _ in _ANSWER]
    return pa.Table.from_arrays([pa.array(c, f.type) for c, f in zip(columns, _ANSWER)], schema=_ANSWER)


def _marked(bucket: np.ndarray, answers: list[dict]) -> np.ndarray:
    """Whether each key is frequent, put together from the bits of its bucket."""
    bits = {a["bucket"]: a["bits"] for a in answers}
    kept = np.zeros(len(bucket), bool)
    for number, places in _in_buckets(bucket):
        if number in bits:
            kept[places] = np.unpackbits(np.frombuffer(bits[number], np.uint8), count=len(places)).astype(bool)
    return kept


def _ask_words(buckets: int):
    def ask(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                yield from _ask(_keys(row["keys"]), _numbers(row["counts"], np.int64), buckets, row["lang"], row["shard"])

    return ask


def _cut_at_rare_words(text: np.ndarray, kept: np.ndarray) -> np.ndarray:
    """The text with the kept words (a flag for each, from number 1) numbered anew, the others as breaks."""
    renumbered = np.append(0, np.where(kept, np.cumsum(kept), 0))
    text = _joined_breaks(renumbered[text])
    following, preceding = np.append(text[1:], 0), np.append(0, text[:-1])
    return _joined_breaks(np.where((following == 0) & (preceding == 0), 0, text))


def _cut_at_rare_pairs(text: np.ndarray, first: np.ndarray, second: np.ndarray) -> np.ndarray:
    """The text with a break wherever two neighbours are no kept pair."""
    base = int(text.max()) + 1
    linked = np.isin(text[:-1] * base + text[1:], first * base + second)
    cut = np.zeros(2 * len(text), np.int64)
    cut[0::2] = text  # behind each word a place for a break
    stays = np.ones(len(cut), bool)
    stays[1:-1:2] = ~linked
    alone = ~np.append(linked, False) & ~np.append(False, linked)
    cut[0::2][alone] = 0
    return _joined_breaks(np.append(0, cut[stays]))


class _Pairs:
    """A shard cut at rare words: its words, its text, and the hashes of its pairs in order."""

    def __init__(self, row: dict, word_buckets: int, bits: int) -> None:
        self.bits = bits
        words = _keys(row["keys"])
        kept = _marked(_dealt(words, word_buckets), row["answers"])
        self.words = [w for w, ok in zip(words, kept.tolist()) if ok]
        self.text = _cut_at_rare_words(_numbers(row["text"], np.int32), kept)
        hashes = np.fromiter(map(xxhash.xxh64_intdigest, self.words), np.uint64, len(self.words))
        (first, second), counts = next(phrases(self.text, 2), ((np.zeros(0, np.int64),) * 2, np.zeros(0, np.int64)))
        pair = mixed(mixed(hashes[first - 1]) + hashes[second - 1]) >> np.uint64(64 - bits)
        order = np.argsort(pair, kind="stable")
        self.first, self.second, self.counts, self.hashes = (c[order] for c in (first, second, counts, pair))

    def buckets(self, number: int) -> np.ndarray:
        """Neighbouring hashes share a bucket, and compress well as a block."""
        width = -(-(1 << self.bits) // number)
        return (self.hashes // np.uint64(width)).astype(np.int64)


def _ask_pairs(word_buckets: int, pair_buckets: int, least: int, bits: int):
    def ask(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                pairs = _Pairs(row, word_buckets, bits)
                # Counts beyond what is asked for make no difference.
                counts = np.minimum(pairs.counts, least).astype(np.min_scalar_type(least))
                for bucket, places in _in_buckets(pairs.buckets(pair_buckets)):
                    keys, n = _hashes_zipped(pairs.hashes[places]), _zipped(counts[places].tobytes())
                    yield _row(_BLOCK, row["lang"], bucket, row["shard"], keys, n)

    return ask


def _list_phrases(word_buckets: int, pair_buckets: int, longest: int, bits: int):
    def ask(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                pairs = _Pairs(row, word_buckets, bits)
                kept = _marked(pairs.buckets(pair_buckets), row["pair_answers"])
                text = _cut_at_rare_pairs(pairs.text, pairs.first[kept], pairs.second[kept])
                words = pa.array(pairs.words, pa.binary())
                for columns, counts in phrases(text, longest):
                    parts = [words.take(pa.array(c - 1)) for c in columns]
                    keys = pc.binary_join_element_wise(*parts, b" ").to_pylist()
                    yield from _ask(keys, counts, pair_buckets, row["lang"], row["shard"])

    return ask


def frequencies(docs: DataFrame, params: Collocations, lang: str, text: str) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Words (lang, phrase, f) and phrases (lang, phrase, f) that occur often enough, and n of each lang."""
    given = docs.select(
        F.coalesce(F.col(lang).cast("string"), F.lit(UNKNOWN)).alias("lang"), whole(F.col(text)).alias("text")
    )
    shards = written(given.mapInArrow(_shards(params.shard_words), _Shard.schema), "shards")
    totals = shards.groupBy("lang").agg(F.sum("words").alias("n"))
    words, kinds = shards.agg(F.sum("words"), F.sum("kinds")).first()
    word_buckets, pair_buckets = (1 + (n or 0) // BUCKET for n in (kinds, words))

    def added(blocks: DataFrame, answer, label: str) -> DataFrame:
        return written(blocks.groupBy("lang", "bucket").applyInArrow(answer, _ANSWER_SCHEMA), label)

    def for_shards(answers: DataFrame, name: str) -> DataFrame:
        """Bits for each shard; joined by sorting at any size, as they grow with the corpus."""
        each = answers.where("shard IS NOT NULL").groupBy("shard")
        return each.agg(F.collect_list(F.struct("bucket", "bits")).alias(name)).hint("merge")

    often = lambda answers: answers.where("phrase IS NOT NULL").select("lang", "phrase", "f")
    with session_conf(docs.sparkSession, FEW_ROWS):
        asked = shards.select("lang", "shard", "keys", "counts").mapInArrow(_ask_words(word_buckets), _BLOCK_SCHEMA)
        word_answers = added(asked, _answer(params.least, True), "words")
        read = shards.select("shard", "lang", "text", "keys").join(for_shards(word_answers, "answers"), "shard")
        asked = read.mapInArrow(_ask_pairs(word_buckets, pair_buckets, params.least, params.hash_bits), _BLOCK_SCHEMA)
        pair_answers = added(asked, _answer_hashes(params.least), "pairs")
        read = read.join(for_shards(pair_answers, "pair_answers"), "shard")
        listed = read.mapInArrow(_list_phrases(word_buckets, pair_buckets, params.longest, params.hash_bits), _BLOCK_SCHEMA)
        found = added(listed, _answer(params.least, False), "phrases")
    return often(word_answers), often(found), totals


def _scored(candidates: DataFrame, words: DataFrame, totals: DataFrame) -> DataFrame:
    """lang, phrase, a, n and ``cut`` (score, k, l, r): the cut of each candidate with the lowest score."""
    copy = F.pmod(F.xxhash64("phrase"), F.lit(COPIES))
    split = F.split("phrase", " ", -1)
    cuts = candidates.select(
        "lang", "phrase", F.col("f").alias("a"), copy.alias("copy"), split.alias("w"),
        F.explode(F.sequence(F.lit(1), F.size(split) - 1)).alias("k"),
    ).select(
        "lang", "phrase", "a", "copy", "k",
        F.array_join(F.slice("w", F.lit(1), F.col("k")), " ").alias("left"),
        F.array_join(F.slice("w", F.col("k") + 1, F.size("w")), " ").alias("right"),
    )
    copies = F.explode(F.sequence(F.lit(0).cast("long"), F.lit(COPIES - 1).cast("long"))).alias("copy")
    parts = words.union(candidates.select(*words.columns)).select("lang", "phrase", "f", copies)
    side = lambda part, f: parts.select("lang", "copy", F.col("phrase").alias(part), F.col("f").alias(f))
    whole_number = lambda c: F.col(c).cast("decimal(19,0)")
    with_parts = (
        cuts.join(side("left", "l"), ["lang", "copy", "left"])
        .join(side("right", "r"), ["lang", "copy", "right"])
        .join(totals, "lang")
        .withColumn("over", F.lit(1000).cast("decimal(4,0)") * whole_number("a"))
        .withColumn("over", F.col("over").cast("decimal(19,0)") * whole_number("n"))
        .withColumn("under", whole_number("l") * whole_number("r"))
    )
    lowest = F.min(F.struct(F.expr("over div under").alias("score"), "k", "l", "r"))
    return with_parts.groupBy("lang", "phrase", "a", "n").agg(lowest.alias("cut"))


def _covered(candidates: DataFrame, contained: int) -> DataFrame:
    """lang, phrase: candidates that a longer one covers.

    A candidate of one word more is inside every longer one, and as frequent at least, so those
    of one word more decide.
    """
    split = F.split("phrase", " ", -1)
    longer = candidates.where(F.size(split) > 2).select("lang", F.col("f").alias("longer"), split.alias("w"))
    inside = longer.select(
        "lang", "longer", F.explode(F.array(F.slice("w", F.lit(1), F.size("w") - 1), F.slice("w", F.lit(2), F.size("w")))).alias("w")
    )
    most = inside.groupBy("lang", F.array_join("w", " ").alias("phrase")).agg(F.max("longer").alias("longer"))
    both = most.join(candidates, ["lang", "phrase"])
    return both.where(100 * F.col("longer") >= contained * F.col("f")).select("lang", "phrase")


def mine(
    docs: DataFrame, params: Collocations = Collocations(), lang: str = "lang", text: str = "text"
) -> DataFrame:
    """The first phrases of each language: lang, rank, phrase, a, l, r, n, score.

    ``a`` counts the phrase, ``l`` and ``r`` the parts of its lowest-scoring cut, ``n`` all words of
    the language; score is floor(1000·a·n / (l·r)), in whole numbers that do not overflow. Order:
    score and a descending, phrase ascending by bytes. A null text is empty, a null language
    ``und``; repeated rows count as often as they come; a text of any length is one shard's; other
    columns, whatever their names, are not read. No rows, or nothing frequent, give no phrase.
    """
    words, candidates, totals = frequencies(docs, params, lang, text)
    kept = _scored(candidates, words, totals).join(_covered(candidates, params.contained), ["lang", "phrase"], "left_anti")
    flat = kept.select("lang", "phrase", "a", F.col("cut.l").alias("l"), F.col("cut.r").alias("r"), "n", F.col("cut.score").alias("score"))
    order = [F.col("score").desc(), F.col("a").desc(), F.col("phrase")]
    first = first_rows(flat, "lang", order, params.most, F.col("phrase"))
    return first.select("lang", "rank", "phrase", "a", "l", "r", "n", "score")
