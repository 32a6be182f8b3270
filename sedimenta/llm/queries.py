"""Each operator over its whole table, with the digest columns that its result is judged by."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sedimenta.llm import (
    chat,
    collocations,
    decontaminate,
    fim,
    importance,
    language,
    mixing,
    neardup,
    quality,
    secrets,
    sharding,
    spans,
    urls,
)
from sedimenta.llm.words import whole


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return quality.judge(docs, table(spark, sf_dir, "labels"), with_text=False)


def op2_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    judged = decontaminate.decontaminate(docs, table(spark, sf_dir, "benchmark"))
    return judged.select(
        "doc_id",
        "n_words",
        "n_hit",
        F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join("items", ",").cast("binary"), 256).alias("items_sha256"),
        "contaminated",
    )


def op3_sentence_spans(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return spans.remove_repeated_spans(docs)


def op4_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    text = whole(F.col("text"))
    return sharding.random_shards(docs).select(
        "doc_id",
        (F.octet_length(text) + 8).cast("long").alias("size"),
        F.crc32(text.cast("binary")).alias("text_crc32"),
        F.lit("rows").alias("law"),
        "shard",
        "slot",
        F.lit(None).cast("int").alias("grown_shard"),
    )


#: The policy of the contract.
POLICY = [
    urls.PolicyRule("com", "/", "allow"),
    urls.PolicyRule("example.com", "/en/", "block"),
    urls.PolicyRule("www.example.com", "/en/", "allow"),
    urls.PolicyRule("net", "/es/", "block"),
    urls.PolicyRule("net", "/fr/", "block"),
]


def labelled_urls(pages: DataFrame, labels: DataFrame) -> DataFrame:
    """URLs of the pages that have a label: block where it says low quality or toxic."""
    bad = F.coalesce(F.col("quality") == 0, F.lit(False)) | F.coalesce(F.col("toxic") == 1, F.lit(False))
    verdict = F.when(bad, "block").otherwise("allow").alias("verdict")
    known = labels.select(F.col("doc_id").alias("page_id"), verdict)
    return pages.join(known, "page_id").select("url", "verdict")


def op5_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages").select("page_id", "url")
    judged = urls.judge_urls(pages, POLICY, labelled_urls(pages, table(spark, sf_dir, "labels")))
    return judged.select("page_id", "host", "path", "rule", "verdict", "confidence")


def op6_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "source", "text")
    mixed = mixing.mix(docs, mixing.word_count(F.col("text")))
    return mixed.select("doc_id", "size", "source_size", "target", "taken")


def op7_importance(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return importance.draw(docs, table(spark, sf_dir, "labels"), with_text=False)


def op8_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    found = secrets.secret_spans(docs)
    base = [(kind, F.col(kind)) for kind in secrets.KINDS if kind != "entropy"]
    every = [(kind, F.col(kind)) for kind in secrets.KINDS]
    return found.select(
        "doc_id",
        *[F.size(kind).cast("long").alias(f"n_{kind}") for kind in secrets.KINDS],
        F.sha2(secrets.listed(base).cast("binary"), 256).alias("base_sha256"),
        secrets.listed(every).alias("spans"),
    )


def op9_chat(spark: SparkSession, sf_dir: str) -> DataFrame:
    said = r"\### Assistant: </turn> ok"
    given = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    more = spark.createDataFrame([(-7, 0, "user", said), (-7, 1, "assistant", said)], given.schema)
    read = chat.read_back(chat.chat_windows(given.union(more)))
    return read.select(
        "conv_id",
        "n_turns",
        F.sha2(F.col("turns_text").cast("binary"), 256).alias("turns_sha256"),
        F.length("loss_text").cast("long").alias("loss_chars"),
        F.sha2(F.col("loss_text").cast("binary"), 256).alias("loss_sha256"),
        "formatted_chars",
    )


def op10_near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    params = neardup.NearDuplicates(width=3, percent=85)
    found = neardup.near_duplicates(docs, params)
    return found.select(
        "doc_id", "n_shingles", "component_id", (F.col("doc_id") == F.col("component_id")).alias("kept")
    )


def op11_fill_in_middle(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    made = fim.fill_in_middle(docs)
    digest = lambda text: F.sha2(text.cast("binary"), 256)
    return made.select(
        "doc_id",
        "n",
        "form",
        F.length("prefix").cast("long").alias("prefix_chars"),
        F.length("middle").cast("long").alias("middle_chars"),
        digest(F.col("output")).alias("output_sha256"),
        digest(fim.restored(F.col("output"), F.col("form"))).alias("restored_sha256"),
    )


def op12_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collocations.mine(table(spark, sf_dir, "documents").select("lang", "text"))


def op13_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    held_out = F.crc32(whole(F.col("doc_id").cast("string")).cast("binary")) % 5 == 0
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang", held_out.alias("held_out"))
    profiles = language.fit(docs, ~F.col("held_out"))
    judged = language.identify(docs.drop("lang"), profiles)
    return judged.select("doc_id", "held_out", "lang_pred", "score")


ALL: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_quality_rules": op1_quality_rules,
    "op2_decontaminate": op2_decontaminate,
    "op3_sentence_spans": op3_sentence_spans,
    "op4_shards": op4_shards,
    "op5_url_filter": op5_url_filter,
    "op6_mix": op6_mix,
    "op7_importance": op7_importance,
    "op8_secrets": op8_secrets,
    "op9_chat": op9_chat,
    "op10_near_duplicates": op10_near_duplicates,
    "op11_fill_in_middle": op11_fill_in_middle,
    "op12_collocations": op12_collocations,
    "op13_language": op13_language,
}
