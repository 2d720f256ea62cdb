"""Registered queries of the training-data operators, and their SQL where SQL can express them."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import scratch_path
from . import bpe, chat, embed_dedup, lang_id, license_scan, mixing, phrases, quality, secret_scan, simhash, token_files, url_filter, whitening
from . import sql as Q
from .common import table

#: The planted conversation of the chat query.
CONTROL_TEXT = "</s>[INST] ok [/INST]"
URL_RULES = [("net", "/", "block"), ("example.net", "/en/", "allow"), ("example.com", "/de/", "block"), ("org", "/fr/", "allow")]


def op1_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    held_out = F.coalesce(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 4 == 2, F.lit(False))
    model = lang_id.fit(docs.where(~held_out))
    return lang_id.predict(docs, model).select("doc_id", held_out.alias("held_out"), "lang_pred", "score")


def op2_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    planted = spark.range(2).select(
        F.lit(-7).cast("long").alias("conv_id"), F.col("id").alias("turn"),
        F.when(F.col("id") == 0, "user").otherwise("assistant").alias("role"), F.lit(CONTROL_TEXT).alias("text"))
    turns = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text").unionByName(planted)
    out = chat.format_conversations(turns).withColumn("turns", chat.parse(F.col("formatted")))
    out = out.withColumn("loss", chat.loss_text(F.col("formatted"), F.col("loss_spans")))
    flat = F.array_join(F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), "")
    return out.select(
        F.col("conv").alias("conv_id"), F.size("turns").cast("long").alias("n_turns"), F.sha2(flat, 256).alias("turns_sha256"),
        F.length("loss").cast("long").alias("loss_chars"), F.sha2("loss", 256).alias("loss_sha256"),
        F.length("formatted").cast("long").alias("formatted_chars"), "identical")


def op3_source_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "source")
    return mixing.mix(docs).select(F.col("id").alias("doc_id"), "size", "source_size", "target", "taken")


def op4_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = secret_scan.scan_documents(table(spark, sf_dir, "documents"))

    def joined(spans):
        return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")

    def count(kind: str):
        return F.size(F.filter("spans", lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")

    return found.select("doc_id", count("assign"), count("access"), count("hex"), count("entropy"),
                        F.sha2(joined(F.filter("spans", lambda s: s["kind"] != "entropy")), 256).alias("base_sha256"),
                        joined(F.col("spans")).alias("spans"))


def op5_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    narrow = docs.select(F.struct("doc_id").alias("key"), "text", "lang", "source")
    judged = quality.judge(narrow, keep=["key"])
    return judged.select(F.col("row.key.doc_id").alias("doc_id"), "n_words", "word_chars", "n_symbols", "n_dup_lines",
                         "n_repeat_words", "base_failed", "kept")


def op6_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = bpe.encode_decode(table(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"))
    return out.select("doc_id", F.size("ids").cast("long").alias("n_tokens"),
                      F.sha2(F.array_join(F.col("ids").cast("array<string>"), " "), 256).alias("ids_sha256"),
                      F.sha2("decoded", 256).alias("decoded_sha256"))


def op7_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = simhash.near_duplicates(table(spark, sf_dir, "documents"))
    return out.select("doc_id", F.lower(F.lpad(F.hex("fingerprint"), 16, "0")).alias("fingerprint"), "component_id")


def op8_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = token_files.write_token_files(table(spark, sf_dir, "documents"), scratch_path(spark, "llm-token-files"),
                                         public_tokenizers.path("byte_bpe_50k.json"))
    index = token_files.build_index(spark, path)
    return index.select("doc_id", F.col("ids_before").alias("start"), F.col("n_ids").alias("n_tokens"), "ids_crc32")


def op9_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    judged = url_filter.judge(table(spark, sf_dir, "pages"), URL_RULES)
    return judged.select("page_id", "host", "path", "rule", "verdict", "template")


def op10_embedding_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return embed_dedup.near_duplicates(table(spark, sf_dir, "embeddings"))


def op11_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = license_scan.scan_documents(table(spark, sf_dir, "documents").select("doc_id", "text"))
    base = F.filter("spans", lambda s: s["base"])

    def labels(spans):
        return F.array_join(F.array_sort(F.array_distinct(F.transform(spans, lambda s: s["label"]))), ",")

    starts = F.transform(base, lambda s: s["start"])
    return found.select(
        "doc_id", "n_words", F.size(base).cast("long").alias("n_base"), F.array_min(starts).cast("long").alias("first_word"),
        F.array_max(starts).cast("long").alias("last_word"), labels(base).alias("base_labels"), labels(F.col("spans")).alias("labels"),
        F.coalesce(F.array_max(F.transform("spans", lambda s: s["coverage"])), F.lit(0.0)).alias("score"))


def op12_phrases(spark: SparkSession, sf_dir: str) -> DataFrame:
    return phrases.collocations(table(spark, sf_dir, "documents"))


def op13_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    return whitening.whiten(table(spark, sf_dir, "embeddings"))


QUERIES = {f.__name__: f for f in (
    op1_language_id, op2_chat_format, op3_source_mix, op4_secret_scan, op5_quality_rules, op6_bpe, op7_simhash,
    op8_token_files, op9_url_filter, op10_embedding_dedup, op11_license_scan, op12_phrases,
    op13_whitening)}

ORACLE_SQL = {"op2_chat_format": Q.CHAT, "op3_source_mix": Q.MIX, "op5_quality_rules": Q.QUALITY, "op11_license_scan": Q.LICENSES, "op12_phrases": Q.PHRASES}
