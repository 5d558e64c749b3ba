"""A training corpus from raw documents, in stages that each write their result.

Every stage takes and returns documents with all their columns; the last one
returns packed token ids. A stage works on what the one before kept.
"""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quotemill.llm import bpe, line_dedup, mixing, near_dups, quality
from quotemill.llm.common import labels, ship_package, unused, words_of
from quotemill.session import scratch_path

TOKENIZER = "byte_bpe_50k.json"
LEAST_SCORE = 0.5


def keep_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops documents the compression classifier takes for bad."""
    ship_package(spark)
    model = quality.fit(docs.select("doc_id", "text"), labels(spark, sf_dir))
    score = quality.classifier(spark, model)
    return docs.where(score("text") >= LEAST_SCORE)


def drop_boilerplate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Removes lines that stand on many sources; the character count follows the text."""
    ship_package(spark)
    return line_dedup.with_clean_text(docs).withColumn("n_chars", F.length("text").cast("bigint"))


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps one document of each group of near duplicates."""
    ship_package(spark)
    return near_dups.one_of_each(docs)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Brings sources to their target weights; a document read twice stands twice."""
    ship_package(spark)
    mix = mixing.Mix(docs, F.col("source"), words_of(F.col("text")), F.col("text"))
    times, turn = unused(docs, "__readings"), unused(docs, "__reading")
    read = mix.readings(docs, times).where(F.col(times) > 0)
    again = F.explode(F.sequence(F.lit(1), F.col(times)))
    return read.withColumn(turn, again).select(*[F.col(f"`{name}`") for name in docs.columns])


def encode_tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of every document, and whether decoding gives its text back."""
    ship_package(spark)
    coded = bpe.codec(docs, public_tokenizers.path(TOKENIZER), ["doc_id", "lang", "source", "text"])
    return coded.select(
        "doc_id", "lang", "source", bpe.token_count(F.col("token_ids")).alias("n_tokens"), "token_ids",
        (F.col("decoded") == F.coalesce("text", F.lit(""))).alias("round_trip"))


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("quality", keep_quality),
    ("line_dedup", drop_boilerplate),
    ("near_duplicates", drop_near_duplicates),
    ("mix", mix_sources),
    ("tokens", encode_tokens),
]

# Fitted models, MinHash and token merges are not expressible in SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages on the documents table, each written to the shared folder and read again."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        path = scratch_path(spark, f"pipeline-{name}")
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return STAGES[-1][1](spark, docs, sf_dir)


QUERIES = {"pipeline": run}
SQL: dict[str, str] = {}
