"""The corpus pipeline: documents through five stages, each written as Parquet and read again."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from loadkit.llm import bpe, mixing, pii, quality, simhash
from loadkit.llm.common import prepare, table, unused
from loadkit.session import stage

# The stages learn models and hash by XXH64, which SQL cannot state; tests/llm compares them with plain versions.
ORACLE_SQL = None


def good_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier accepts.

    It learns from the labelled rows of `docs`. Null and empty texts are scored like others; repeated rows stand or fall together; no rows give no rows.
    """
    prepare(spark)
    model = quality.fit(docs, quality.learnable(table(spark, sf_dir, "labels")))
    out = unused(docs.columns, "_score")
    return quality.score(docs, model, out=out).filter(F.col(out) >= quality.ACCEPT).select(*docs.columns)


def one_of_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates, by the shingle length and bit distance of `simhash`.

    The smallest id stays. Rows without an id stay only where no row with one is near; one of repeated rows stays, and one of all texts without words. No rows give no rows.
    """
    prepare(spark)
    return simhash.keep_one(docs)


def without_personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with personal data replaced by marks, and their length counted anew.

    Every row stays; null texts stay null, empty ones empty; repeated rows are redacted alike; no rows give no rows.
    """
    prepare(spark)
    clean = pii.redact(docs, pii.fit(docs))
    if "n_chars" in docs.columns:
        clean = clean.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType))
    return clean


def mixed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix takes them.

    Null texts and texts without words are never taken; a null source is a source; repeated rows share their copies; no rows give no rows.
    """
    prepare(spark)
    return mixing.take(docs)


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids (little-endian unsigned 32-bit integers) and digests of them and of the text they decode to.

    Null and empty texts have no tokens; repeated rows and null ids stay; no rows give no rows.
    """
    prepare(spark)
    vocabulary = bpe.Vocabulary(public_tokenizers.path("byte_bpe_50k.json"))
    decoded = bpe.decode(bpe.encode(docs, vocabulary), vocabulary)
    return decoded.select(
        "doc_id", "ids", (F.length("ids") / 4).cast("bigint").alias("n_tokens"), F.sha2("ids", 256).alias("ids_sha256"), F.sha2(F.col("decoded").cast("binary"), 256).alias("decoded_sha256"))


STAGES = [("quality", good_quality), ("near_duplicates", one_of_near_copies), ("personal_data", without_personal_data), ("mix", mixed), ("bpe", tokens)]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    prepare(spark)
    docs = table(spark, sf_dir, "documents")
    for name, function in STAGES:
        docs = stage(function(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
