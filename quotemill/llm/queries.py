"""Registered queries of the corpus operators: thin digests of what they return."""

from __future__ import annotations

import zlib
from collections.abc import Callable

import public_tokenizers
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from quotemill.llm import (
    bit_slices, bpe, cascade, licenses, line_dedup, merkle, mixing, near_dups, packing,
    periodic, pii, quality, token_counts)
from quotemill.llm.common import documents, labels, ship_package, words_of
from quotemill.llm.sql import SQL  # noqa: F401

TOKENIZER = "byte_bpe_50k.json"
TOKEN_LIMIT = 512
# Its words end at blanks, which it drops.
WORD_TOKENIZER = "word_bpe_49k.json"
END_TOKEN = 2
TOP = 5
UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"


def op1_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Personal data in every document: base spans and those the field adds."""
    docs = documents(spark, sf_dir)
    find = pii.finder(spark, pii.estimated(docs))
    found = docs.select("doc_id", find("text").alias("spans"))

    def written(spans: Column) -> Column:
        return F.array_join(F.transform(
            spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")

    def of_kind(kind: str) -> Column:
        return F.size(F.filter(base, lambda s: s["kind"] == kind)).cast("bigint")

    base = F.filter("spans", lambda s: ~s["added"])
    return found.select(
        "doc_id",
        *[of_kind(kind).alias(f"n_{kind}") for kind in pii.KINDS],
        F.sha2(written(base), 256).alias("base_sha256"),
        written(F.col("spans")).alias("spans"),
    )


def op2_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Licenses named in every document."""
    scan = licenses.scanner()
    found = documents(spark, sf_dir).select("doc_id", scan("text").alias("s"))

    def joined(labels: Column) -> Column:
        return F.array_join(F.array_sort(F.array_distinct(labels)), ",")

    starts = F.transform("s.places", lambda place: place["start"])
    base = F.transform("s.places", lambda place: place["label"])
    own = F.transform("s.detections", lambda found: found["label"])
    return found.select(
        "doc_id", "s.n_words",
        F.size("s.places").cast("bigint").alias("n_base"),
        F.array_min(starts).alias("first_word"),
        F.array_max(starts).alias("last_word"),
        joined(base).alias("base_labels"),
        joined(F.concat(base, own)).alias("labels"),
        "s.score",
    )


def op3_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quality score of every document, learnt outside the held-out fold."""
    docs = documents(spark, sf_dir)
    score = quality.classifier(spark, quality.fit(docs, labels(spark, sf_dir)))
    scored = docs.select("doc_id", score("text").alias("score"))
    return scored.select(
        "doc_id", quality.held_out(F.col("doc_id")).alias("held_out"), "score",
        (F.col("score") >= 0.5).cast("int").alias("predicted"),
    )


def op4_line_spread(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document without the lines that stand on many sources."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text", "source")
    return line_dedup.without_boilerplate(docs)


def op5_top_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The five best matches of every fiftieth vector among all others."""
    ship_package(spark)
    vectors = spark.read.parquet(f"{sf_dir}/embeddings.parquet").select("vec_id", "embedding")
    return bit_slices.top_k(vectors, F.col("vec_id") % 50 == 0, TOP)


def op6_rule_cascade(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Base counts and verdict of the rule cascade for every document."""
    docs = documents(spark, sf_dir)
    judge = cascade.cascade(cascade.estimated_order(docs))
    return docs.select("doc_id", judge("text").alias("j")).select("doc_id", "j.*")


def op7_source_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words the mix takes of every document, with its source's size and target."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text", "source")
    sized = docs.select("doc_id", "source", "text", words_of(F.col("text")).alias("size"))
    mix = mixing.Mix(sized, F.col("source"), F.col("size"), F.col("text"))
    read = mix.readings(sized, "readings").drop("text").alias("d")
    sources = mix.sources.alias("s")
    return read.join(sources, F.col("d.source").eqNullSafe(F.col("s.source"))).select(
        "doc_id", "size", "source_size", "target", (F.col("size") * F.col("readings")).alias("taken"))


def op8_near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Component of near duplicates of every document."""
    return near_dups.near_duplicates(documents(spark, sf_dir))


def op9_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Exact token count of every document and the longest prefix within the limit."""
    count = token_counts.prefix_counter(spark, public_tokenizers.path(TOKENIZER), budgets=[TOKEN_LIMIT])
    counted = documents(spark, sf_dir).select("doc_id", count("text").alias("counts"))
    return counted.select(
        "doc_id", "counts.n_bytes", "counts.n_tokens",
        (F.col("counts.n_tokens") > TOKEN_LIMIT).alias("over_limit"),
        F.col("counts.cuts")[0].alias("fits_chars"),
    )


def op10_bpe_codec(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document encoded and decoded again."""
    coded = bpe.codec(documents(spark, sf_dir), public_tokenizers.path(TOKENIZER), ["doc_id"])
    return coded.select(
        "doc_id", bpe.token_count(F.col("token_ids")).alias("n_tokens"),
        F.sha2("token_ids", 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )


def op11_merkle(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Manifest of all documents; a fifth of them is received in lower case."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select(*merkle.FIELDS)
    lowered = F.translate("text", UPPER, UPPER.lower())
    tampered = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 5 == 0
    found = merkle.manifest(docs, seen={"text": lowered}, when=tampered)
    return found.select(
        "doc_id", "leaf", "subroot", "root", F.sha2(merkle.proof(F.col("path")), 256).alias("proof_sha256"),
        "folded_root", "verified")


def op12_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents as pieces of sequences of 4096 tokens, similar ones together."""
    found = packing.corpus(documents(spark, sf_dir), public_tokenizers.path(WORD_TOKENIZER), END_TOKEN, by_word=True)
    return packing.pack(found).select(
        F.col("id").alias("doc_id"), "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens",
        "sequence_id", "offset")


def op13_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Periodic runs of every document, a tenth of which is made to repeat from some word on."""

    def looped(number: object, words: list[bytes]) -> list[bytes]:
        mark = 1 if number is None else zlib.crc32(str(number).encode())
        if mark % 10 or not words:
            return words
        seed = mark // 10
        start = seed % len(words)
        period = 1 + (len(words) - start) // (3 + seed % 8)
        return words[:start] + [words[start + k % period] for k in range(len(words) - start)]

    found = periodic.collapsed(documents(spark, sf_dir), change=looped)

    def better(a: Column, b: Column) -> Column:
        """Order of two runs: the greater length by period, then the smaller start and period."""
        gain = b["length"] * a["period"] - a["length"] * b["period"]
        by_place = F.when(a["start"] != b["start"], F.signum(a["start"] - b["start"])).otherwise(
            F.signum(a["period"] - b["period"]))
        return F.when(gain != 0, F.signum(gain)).otherwise(by_place).cast("int")

    best = F.get(F.array_sort("runs", better), F.lit(0))
    line = F.transform("runs", lambda r: F.concat_ws(
        ",", r["start"].cast("string"), r["length"].cast("string"), r["period"].cast("string")))
    listed = F.concat(F.array_join(line, "\n"), F.when(F.size("runs") > 0, "\n").otherwise(""))
    return found.select(
        "doc_id", F.size("runs").cast("bigint").alias("n_runs"), best.alias("best"),
        F.sha2(listed, 256).alias("runs_sha256"), F.sha2("collapsed", 256).alias("collapsed_sha256"),
    ).select(
        "doc_id", "n_runs", "best.start", "best.length", "best.period",
        F.expr("1000 * best.length div best.period").alias("exponent_milli"), "runs_sha256", "collapsed_sha256")


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_pii": op1_pii,
    "op2_license_scan": op2_license_scan,
    "op3_quality": op3_quality,
    "op4_line_spread": op4_line_spread,
    "op5_top_k": op5_top_k,
    "op6_rule_cascade": op6_rule_cascade,
    "op7_source_mix": op7_source_mix,
    "op8_near_duplicates": op8_near_duplicates,
    "op9_token_counts": op9_token_counts,
    "op10_bpe_codec": op10_bpe_codec,
    "op11_merkle": op11_merkle,
    "op12_packing": op12_packing,
    "op13_runs": op13_runs,
}
