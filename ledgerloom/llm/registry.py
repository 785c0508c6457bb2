"""The registered queries: each applies one operator to its whole table."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerloom.llm.audit import audit_filters
from ledgerloom.llm.bpe import encode_texts
from ledgerloom.llm.cascade import judge_documents
from ledgerloom.llm.chat import format_conversations, learned_texts, turns_of
from ledgerloom.llm.html_text import extract_text
from ledgerloom.llm.langid import held_out, identify_languages, learn_languages
from ledgerloom.llm.lz import edited_neighbours
from ledgerloom.llm.mixing import mix_sources
from ledgerloom.llm.onebit import nearest
from ledgerloom.llm.runindex import remove_repeats
from ledgerloom.llm.simhash import hexadecimal, near_duplicates
from ledgerloom.llm.spelling import group_spellings
from ledgerloom.llm.warc import ID, read_archives, with_revisits, write_archives
from ledgerloom.sources import work_folder

Query = Callable[[SparkSession, str], DataFrame]

VOCABULARY = "word_bpe_49k.json"


def table(spark: SparkSession, sf_dir: str, name: str, *columns: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet").select(*columns)


def op1_langid(spark: SparkSession, sf_dir: str) -> DataFrame:
    model = learn_languages(table(spark, sf_dir, "documents", "doc_id", "text", "lang"))
    docs = table(spark, sf_dir, "documents", "doc_id", "text")
    labelled = identify_languages(docs, model, keep=["doc_id"])
    return labelled.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "lang_pred", "score")


def op2_html(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages", "page_id", "url", "html")
    texts = extract_text(pages, keep=["page_id", "url"])
    return texts.withColumn("n_chars", F.length("text").cast("long"))


def op3_lz(spark: SparkSession, sf_dir: str) -> DataFrame:
    return edited_neighbours(table(spark, sf_dir, "documents", "doc_id", "text")).withColumnRenamed("key", "doc_id")


def op4_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = work_folder(spark, "warc")
    pages = table(spark, sf_dir, "pages", "page_id", "url", "html")
    write_archives(with_revisits(pages)).write.option("compression", "uncompressed").parquet(folder)
    records = read_archives(spark.read.parquet(folder), payloads=False)

    def number(urn: str):
        return F.expr(f"try_cast(substr({urn}, {len(ID) + 1}) AS bigint)")

    return records.select(
        number("record_id").alias("page_id"),
        "payload_bytes",
        "payload_digest",
        "record_type",
        number("refers_to").alias("refers_to"),
    )


def op5_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents", "doc_id", "text")
    encoded = encode_texts(docs, public_tokenizers.path(VOCABULARY), keep=["doc_id"], decoded="decoded")
    return encoded.select(
        "doc_id",
        "n_tokens",
        F.sha2("ids", 256).alias("ids_sha256"),
        F.sha2(F.encode("decoded", "UTF-8"), 256).alias("decoded_sha256"),
    )


def op6_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents", "doc_id", "text", "source")
    return mix_sources(docs).select("doc_id", "size", "source_size", "target", "taken")


def op7_runindex(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents", "doc_id", "text")
    return remove_repeats(docs, keep=["doc_id"]).select(
        "doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256")
    )


# The conversation that the contract adds: its texts hold the template's control strings.
ADDED_TEXT = "\\### Assistant: </turn> ok"


def op8_chat(spark: SparkSession, sf_dir: str) -> DataFrame:
    turns = table(spark, sf_dir, "conversations", "conv_id", "turn", "role", "text")
    added = spark.range(2).select(
        F.lit(-7).alias("conv_id"),
        F.col("id").alias("turn"),
        F.when(F.col("id") == 0, "user").otherwise("assistant").alias("role"),
        F.lit(ADDED_TEXT).alias("text"),
    )
    read_back = turns_of(F.col("formatted"))
    lines = F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n")))
    return (
        format_conversations(turns.unionByName(added))
        .select(
            "conv_id",
            read_back.alias("turns"),
            F.array_join(learned_texts(F.col("segments")), "").alias("learned"),
            F.length("formatted").cast("long").alias("formatted_chars"),
        )
        .select(
            "conv_id",
            F.size("turns").cast("long").alias("n_turns"),
            F.sha2(F.encode(F.array_join(lines, ""), "UTF-8"), 256).alias("turns_sha256"),
            F.length("learned").cast("long").alias("loss_chars"),
            F.sha2(F.encode("learned", "UTF-8"), 256).alias("loss_sha256"),
            "formatted_chars",
        )
    )


def op9_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents", "doc_id", "text")
    return near_duplicates(docs, words=3, threshold=2).select(
        "doc_id", hexadecimal("fingerprint").alias("fingerprint"), "component_id"
    )


def op10_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    judged = judge_documents(table(spark, sf_dir, "documents", "doc_id", "text"))
    return judged.drop("text").select(
        "doc_id",
        "n_words",
        "word_chars",
        "n_symbols",
        "n_dup_lines",
        "n_repeat_words",
        "base_failed",
        "kept",
    )


def op11_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents", "doc_id", "text", "source")
    return audit_filters(docs, table(spark, sf_dir, "labels", "doc_id", "quality", "toxic"))


def op12_onebit(spark: SparkSession, sf_dir: str) -> DataFrame:
    return nearest(table(spark, sf_dir, "embeddings", "vec_id", "embedding"), F.col("id") % 20 == 0)


def op13_spelling(spark: SparkSession, sf_dir: str) -> DataFrame:
    return group_spellings(table(spark, sf_dir, "documents", "doc_id", "text"))


def queries() -> dict[str, Query]:
    built = (
        op1_langid, op2_html, op3_lz, op4_warc, op5_bpe, op6_mix, op7_runindex, op8_chat, op9_simhash, op10_quality,
        op11_audit, op12_onebit, op13_spelling,
    )
    return {f.__name__: f for f in built}
