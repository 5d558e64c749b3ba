"""Quality classifier by compression with two dictionaries.

A zstandard dictionary is built from labelled good texts and another from bad
ones. A text is compressed in blocks with either, and the difference of the two
sizes, divided by the text's bytes, says which dictionary knew more of it.
Logistic calibration turns the difference into a probability. What compression
alone tells about a text, its size with the good dictionary by byte, goes into
the calibration too, since junk often repeats itself.

Fitting uses a bounded sample: at most ``rows_per_label`` texts of each label,
in the order of a hash of their id, none above ``longest_text`` characters; one
half builds the dictionaries, the other fits the calibration, so that it is
fitted on texts the dictionaries have not seen. Scoring covers all texts whole.

Labels other than 0 and 1, null labels and ids with both labels are left out of
the fit. Without texts of both labels every score is the share of label 1, or
0.5. Null scores as the empty text, which gets the calibration's value at no
difference. Repeated rows give repeated rows; other columns pass through.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass

import numpy as np
import zstandard
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quotemill.llm.common import per_value

ROWS_PER_LABEL = 1_500
LONGEST_TEXT = 30_000
DICTIONARY_BYTES = 112_640
BLOCK_BYTES = 2_048
LEVEL = 3
PRIOR_WEIGHT = 0.02
# Added to a text's bytes, so that a frame's fixed cost does not decide short texts.
FRAME_BYTES = 20


@dataclass(frozen=True)
class Model:
    """Two dictionaries and the calibration of their difference."""

    good: bytes
    bad: bytes
    weights: tuple[float, ...]
    constant: float | None = None


class Sizes:
    """Compressed sizes of a text under a model's dictionaries."""

    def __init__(self, good: bytes, bad: bytes):
        self.compressors = [
            zstandard.ZstdCompressor(
                level=LEVEL, dict_data=zstandard.ZstdCompressionDict(content),
                write_checksum=False, write_content_size=False, write_dict_id=False)
            for content in (good, bad)]

    def features(self, text: str | None) -> tuple[float, float, float]:
        """Constant, normalised size difference, normalised size."""
        spelled = (text or "").encode("utf-8", "surrogatepass")
        if not spelled:
            return 1.0, 0.0, 0.0
        good = bad = 0
        for start in range(0, len(spelled), BLOCK_BYTES):
            block = spelled[start:start + BLOCK_BYTES]
            good += len(self.compressors[0].compress(block))
            bad += len(self.compressors[1].compress(block))
        size = len(spelled) + FRAME_BYTES
        return 1.0, (bad - good) / size, good / size


def probability(features: Sequence[float], weights: Sequence[float]) -> float:
    margin = sum(x * w for x, w in zip(features, weights))
    return float(1 / (1 + np.exp(-np.clip(margin, -30, 30))))


def calibrated(
    features: np.ndarray, labels: np.ndarray, good_share: float = 0.5, rounds: int = 50,
) -> tuple[float, ...]:
    """Logistic weights by Newton steps, with a small prior that keeps them finite.

    The sample holds both labels in other numbers than the corpus; rows are
    weighted so that ``good_share`` of them count as label 1.
    """
    weights = np.zeros(features.shape[1])
    prior = np.diag([1e-6] + [PRIOR_WEIGHT / len(labels)] * (features.shape[1] - 1))
    share = labels.mean()
    importance = np.where(labels == 1, good_share / share, (1 - good_share) / (1 - share))
    for _ in range(rounds):
        expected = 1 / (1 + np.exp(-np.clip(features @ weights, -30, 30)))
        slope = features.T @ (importance * (labels - expected)) / len(labels) - prior @ weights
        curve = (features * (importance * expected * (1 - expected))[:, None]).T @ features / len(labels) + prior
        step = np.linalg.solve(curve, slope)
        size = np.abs(step).max()
        weights = weights + step * min(1.0, 5.0 / size if size else 1.0)
        if size < 1e-8:
            break
    return tuple(float(w) for w in weights)


def dictionary(texts: Sequence[str]) -> bytes:
    """Dictionary content from texts.

    Training picks the substrings that help most; where there is too little
    text for it, the end of the texts themselves serves.
    """
    blocks = [
        spelled[start:start + BLOCK_BYTES]
        for spelled in (text.encode("utf-8", "surrogatepass") for text in texts)
        for start in range(0, len(spelled), BLOCK_BYTES)]
    try:
        return zstandard.train_dictionary(DICTIONARY_BYTES, blocks, level=LEVEL).as_bytes()
    except zstandard.ZstdError:
        return b"".join(blocks)[-DICTIONARY_BYTES:]


def fitted(rows: Sequence[tuple[str, int]], good_share: float = 0.5) -> Model:
    """Model from texts and labels; every second row of a label calibrates."""
    by_label = {label: [text for text, known in rows if known == label] for label in (0, 1)}
    if min(map(len, by_label.values())) < 2:
        share = len(by_label[1]) / len(rows) if rows else 0.5
        return Model(b"", b"", (), share)
    good, bad = dictionary(by_label[1][::2]), dictionary(by_label[0][::2])
    sizes = Sizes(good, bad)
    seen = [(sizes.features(text), label) for label in (0, 1) for text in by_label[label][1::2]]
    weights = calibrated(
        np.array([x for x, _ in seen]), np.array([label for _, label in seen]), good_share)
    return Model(good, bad, weights)


def fold(doc_id: Column) -> Column:
    """Fold 0, 1 or 2 of a document, from its id alone."""
    return F.crc32(doc_id.cast("string").cast("binary")) % 3


def training_rows(
    docs: DataFrame, labels: DataFrame, *, rows_per_label: int = ROWS_PER_LABEL,
    longest_text: int = LONGEST_TEXT,
) -> tuple[list[tuple[str, int]], float]:
    """The bounded sample a model is fitted on, in a fixed order, and the share of label 1.

    Ids are chosen first, so texts of other documents are not moved. The share
    is that of all labelled documents.
    """
    known = (
        labels.where("quality in (0, 1) and doc_id is not null").groupBy("doc_id")
        .agg(F.min("quality").alias("label"), F.max("quality").alias("other"))
        .where("label = other").select("doc_id", "label"))
    order = [F.xxhash64("doc_id"), F.col("doc_id")]
    chosen = [
        known.where(F.col("label") == label).orderBy(*order).limit(rows_per_label) for label in (0, 1)]
    # At most 2 * rows_per_label rows, which bounds the broadcast and the collect.
    few = F.broadcast(chosen[0].unionByName(chosen[1]).withColumnRenamed("doc_id", "_id"))
    texts = (
        # Other columns may have any name.
        docs.select("doc_id", "text").where(F.length("text") <= longest_text)
        .join(few, F.col("doc_id") == F.col("_id"))
        .groupBy("doc_id", "label").agg(F.min("text").alias("text")))
    found = sorted(texts.collect(), key=lambda row: row.doc_id)
    share = known.agg(F.avg("label").cast("double")).first()[0]
    return [(row.text, row.label) for row in found], 0.5 if share is None else share


def classifier(spark: SparkSession, model: Model) -> Callable[..., Column]:
    """Column function: text to its score, the probability of label 1.

    The model's size is that of two dictionaries, whatever the corpus.
    """
    shared = spark.sparkContext.broadcast(model)

    def make() -> Callable[[str | None], float]:
        known = shared.value
        if known.constant is not None:
            return lambda text: known.constant
        sizes = Sizes(known.good, known.bad)
        return lambda text: probability(sizes.features(text), known.weights)

    return per_value(make, T.DoubleType())


def held_out(doc_id: Column) -> Column:
    """Whether a document's label is never learnt from; a null id counts as held out."""
    return F.coalesce(fold(doc_id) == 1, F.lit(True))


def fit(docs: DataFrame, labels: DataFrame, **bounds: int) -> Model:
    """Model from the labelled documents outside the held-out fold."""
    labels = labels.select("doc_id", "quality")
    return fitted(*training_rows(docs, labels.where(~held_out(F.col("doc_id"))), **bounds))
