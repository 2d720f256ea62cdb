"""The corpus pipeline: documents to token ids in five stages.

Each stage works on all that the one before has kept; its result is written as Parquet to the
shared folder and read again by the next.

Every stage takes nulls in any column, texts of any length, repeated rows, empty tables (an empty result with the same columns) and
further columns, whatever their names, which all stages but the last hand on unchanged. Null and empty texts fail the
quality rules, so later stages meet them only where they are run on their own. Ties are settled as each operator states.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from aerocast.llm import bpe, mixing, quality, secret_scan, simhash
from aerocast.llm.common import stage_table, table


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass the fixed and the adaptive rules; null, empty and short texts go, repeated rows share their fate."""
    return quality.keep_good(docs)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of SimHash near-duplicates: the smallest id (null last of all only where it is alone), then
    the smallest text hash; repeated rows count as one, wordless texts as one group."""
    return simhash.keep_one(docs)


def secret_scans(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, secrets in their texts replaced; ``n_chars`` follows the text and stays as it was where the text is null."""
    out = secret_scan.redact_documents(docs)
    return out.withColumn("n_chars", F.coalesce(F.length("text").cast(out.schema["n_chars"].dataType), F.col("n_chars"))) \
        if "n_chars" in out.columns else out


def source_mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Whole documents in the sources' target proportions, repeated where a source's target exceeds its size.

    A null source is one of its own; wordless documents weigh nothing. Rows with equal ids are ordered by size.
    """
    return mixing.mix_documents(docs)


def bpe_tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of every document, with a digest of the text decoded from them; a null text has no ids."""
    out = bpe.encode_decode(docs, public_tokenizers.path("word_bpe_49k.json"))
    return out.select("doc_id", F.size("ids").cast("long").alias("n_tokens"), "ids", F.sha2("decoded", 256).alias("decoded_sha256"))


STAGES = [
    ("quality_rules", quality_rules),
    ("near_duplicates", near_duplicates),
    ("secret_scans", secret_scans),
    ("source_mix", source_mix),
    ("bpe_tokens", bpe_tokens),
]

#: SQL can express neither SimHash nor BPE; the tests hold the stages against brute-force versions.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = stage_table(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
