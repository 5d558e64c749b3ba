"""Packing of documents into full sequences, next to lexically similar ones.

Texts become token ids once; the table of ids is written to the shared folder.
Document frequencies and the mean length are counted over all documents: one row
per vocabulary entry, whatever the corpus.

The BM25 index is sharded. A document's shard follows from its rarest term that
another document has too, so documents that share it meet; terms with few tokens
share a shard, and a term with more than ``SHARD_TOKENS`` is dealt over several.
A task sorts its shards and builds the inverted index of one at a time, of twice
``SHARD_TOKENS`` or one document at most, so its memory does not follow the
corpus, a hot term or a large group of copies.

In a shard, a seed document starts a sequence. The index returns the unused
documents that share terms with it, best first, and they fill the sequence; the
one that does not fit is cut, and its rest is the next seed. Where no neighbour
is left, the next unused document is the seed. Only a shard's last tokens do not
fill a sequence: they become sequences whose lengths are powers of two, which
need no padding.

Null and empty texts consist of the closing token alone. Repeated rows are
documents of their own; ids may repeat or be null. Texts of any length are cut
where a sequence ends. An empty table gives no pieces. Other columns stay out.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass
from pathlib import Path

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from quotemill.llm.common import give_back
from quotemill.llm.word_ids import WholeTexts, Words, library, width_of
from quotemill.session import scratch_path

SEQUENCE = 4096
# Tokens of a shard, about; a task's index covers at most twice as many.
SHARD_TOKENS = 1 << 19
# BM25: how soon repeats of a term saturate, and how much length counts (usual values).
SATURATION = 1.2
LENGTH_SHARE = 0.75
# Bytes of texts a task encodes at a time, or one text if that is longer.
HELD_BYTES = 1 << 25

PIECES = T.StructType([
    T.StructField("start", T.LongType()), T.StructField("length", T.LongType()),
    T.StructField("doc_tokens", T.LongType()), T.StructField("sequence_id", T.LongType()),
    T.StructField("offset", T.LongType()), T.StructField("ids", T.BinaryType())])


@dataclass(frozen=True)
class Corpus:
    """Token ids of all documents, in the shared folder, and counts over them."""

    tokens: DataFrame
    width: str
    # Documents with each term; documents; mean number of terms.
    holders: np.ndarray
    documents: int
    mean: float

    @property
    def weights(self) -> np.ndarray:
        """Inverse document frequency of each term."""
        return np.log1p((self.documents - self.holders + 0.5) / (self.holders + 0.5))


def corpus(
    docs: DataFrame, tokenizer: str, end: int, *, id_col: str = "doc_id", text_col: str = "text",
    by_word: bool = False,
) -> Corpus:
    """Encodes the documents, each closed by the token ``end``, and counts their terms.

    ``by_word`` states that the tokenizer is of the kind ``word_ids`` describes.
    """
    spark = docs.sparkSession
    spelled = Path(tokenizer).read_text(encoding="utf-8")
    size = max(library(spelled).get_vocab_size(), end + 1)
    width = width_of(size)
    shared = spark.sparkContext.broadcast(spelled)
    # Equal rows get numbers of their own, kept with the table.
    chosen = docs.select(
        F.col(f"`{text_col}`").alias("text"), F.col(f"`{id_col}`").alias("id"),
        F.monotonically_increasing_id().alias("row"))
    schema = T.StructType([*chosen.schema.fields[1:], T.StructField("ids", T.BinaryType())])
    shape = to_arrow_schema(schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        made = library(shared.value)
        encode = (Words if by_word else WholeTexts)(made, width)
        close = np.array([end], dtype=width).tobytes()
        for batch in batches:
            column = batch.column(0)
            sizes = pc.fill_null(pc.binary_length(column), 0).to_numpy(zero_copy_only=False)
            # Parts of about as many bytes, so that results do not pile up beside their texts.
            parts = np.cumsum(sizes, dtype=np.int64) // HELD_BYTES
            for part in np.split(np.arange(len(column)), np.flatnonzero(np.diff(parts)) + 1):
                if not len(part):
                    continue
                texts = [text or "" for text in column.slice(part[0], len(part)).to_pylist()]
                ids = pa.array([found + close for found in encode(texts)], pa.binary())
                kept = [c.slice(part[0], len(part)) for c in batch.columns[1:]]
                yield pa.RecordBatch.from_arrays([*kept, ids], schema=shape)
        give_back()

    path = scratch_path(spark, "tokens")
    chosen.mapInArrow(run, schema).write.option("compression", "zstd").parquet(path)
    tokens = spark.read.parquet(path)
    holders, documents, terms = counted(tokens, width, size)
    return Corpus(tokens, width, holders, documents, terms / documents if documents else 0.0)


def flat(column: pa.Array, width: str) -> tuple[np.ndarray, np.ndarray]:
    """All ids of a column of documents, and where each document starts and the last one ends."""
    size = np.dtype(width).itemsize
    kind = np.int64 if pa.types.is_large_binary(column.type) else np.int32
    offsets = np.frombuffer(column.buffers()[1], dtype=kind)[column.offset:column.offset + len(column) + 1]
    ids = np.frombuffer(column.buffers()[2], dtype=width, count=offsets[-1] // size)
    return ids[offsets[0] // size:], (offsets - offsets[0]) // size


def postings(ids: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Each document's different terms and how often it has them, by term and then document.

    The closing token of a document is no term. Both sorts of short integers are
    linear in the ids.
    """
    lengths = np.diff(bounds) - 1
    owner = np.repeat(np.arange(len(lengths), dtype=np.int32), lengths)
    inside = np.ones(len(ids), dtype=bool)
    inside[bounds[1:] - 1] = False
    terms = ids[inside]
    order = np.argsort(terms, kind="stable")
    terms, owner = terms[order], owner[order]
    fresh = np.ones(len(terms), dtype=bool)
    fresh[1:] = (terms[1:] != terms[:-1]) | (owner[1:] != owner[:-1])
    starts = np.flatnonzero(fresh)
    return terms[starts], owner[starts], np.diff(np.append(starts, len(terms)))


def counted(tokens: DataFrame, width: str, size: int) -> tuple[np.ndarray, int, int]:
    """Documents per term, documents, and terms with repeats, over the whole table."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found = np.zeros(size + 2, dtype=np.int64)
        for batch in batches:
            ids, bounds = flat(batch.column(0), width)
            terms, _, _ = postings(ids, bounds)
            found[:size] += np.bincount(terms, minlength=size)
            found[size] += batch.num_rows
            found[size + 1] += len(ids) - batch.num_rows
        present = np.flatnonzero(found)
        yield pa.RecordBatch.from_arrays([pa.array(present), pa.array(found[present])], names=["term", "n"])

    partial = tokens.select("ids").mapInArrow(run, "term bigint, n bigint")
    # One row per vocabulary entry at most.
    rows = partial.groupBy("term").agg(F.sum("n").alias("n")).collect()
    total = np.zeros(size + 2, dtype=np.int64)
    for row in rows:
        total[row["term"]] = row["n"]
    return total[:size], int(total[size]), int(total[size + 1])


def keyed(found: Corpus) -> DataFrame:
    """The token table with each document's key: its rarest term in two documents or more, or -1."""
    spark = found.tokens.sparkSession
    shared_by = np.flatnonzero(found.holders >= 2)
    rarest = shared_by[np.argsort(found.holders[shared_by], kind="stable")]
    # A term's place among them; terms of one document, and none, come last.
    place = np.full(len(found.holders), len(rarest), dtype=np.int32)
    place[rarest] = np.arange(len(rarest), dtype=np.int32)
    shared = spark.sparkContext.broadcast((place, np.append(rarest, -1)))
    width = found.width
    schema = T.StructType([
        *found.tokens.schema.fields, T.StructField("key", T.LongType()), T.StructField("n", T.LongType())])
    shape = to_arrow_schema(schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        place, term = shared.value
        for batch in batches:
            ids, bounds = flat(batch.column("ids"), width)
            places = place[ids]
            places[bounds[1:] - 1] = len(term) - 1
            least = np.minimum.reduceat(places, bounds[:-1]) if batch.num_rows else places
            columns = [pa.array(term[least], pa.int64()), pa.array(np.diff(bounds).astype(np.int64))]
            yield pa.RecordBatch.from_arrays([*batch.columns, *columns], schema=shape)

    return found.tokens.mapInArrow(run, schema)


def sharded(rows: DataFrame, shard_tokens: int) -> DataFrame:
    """The keyed rows with their shard: neighbouring small keys share one, a large key has several."""
    # At most one row per vocabulary entry; a running total over them is one small window.
    sizes = sorted(
        (row["key"], row["n"]) for row in rows.groupBy("key").agg(F.sum("n").alias("n")).collect())
    table, shard, filled = [], 0, 0
    for key, n in sizes:
        parts = -(-n // shard_tokens)
        if filled and filled + n > shard_tokens:
            shard, filled = shard + 1, 0
        table.append((key, shard, parts))
        if parts > 1:
            shard += parts
        else:
            filled += n
    spark = rows.sparkSession
    places = spark.createDataFrame(table, "key bigint, first bigint, parts bigint")
    deal = F.col("first") + F.pmod(F.xxhash64("row"), F.col("parts"))
    return rows.join(F.broadcast(places), "key").withColumn("shard", deal).drop("first", "parts")


class Index:
    """BM25 inverted index of one shard's documents."""

    def __init__(self, documents: list[np.ndarray], weights: np.ndarray, mean: float):
        bounds = np.cumsum([0, *map(len, documents)])
        terms, self.holders, times = postings(np.concatenate(documents), bounds)
        self.count = len(documents)
        drag = SATURATION * (1 - LENGTH_SHARE + LENGTH_SHARE * (np.diff(bounds) - 1) / max(mean, 1.0))
        self.impact = weights[terms] * times * (SATURATION + 1) / (times + drag[self.holders])
        fresh = np.ones(len(terms), dtype=bool)
        fresh[1:] = terms[1:] != terms[:-1]
        self.starts = np.append(np.flatnonzero(fresh), len(terms))
        # A document's terms, by their place in the lists.
        order = np.argsort(self.holders, kind="stable")
        self.terms = (np.cumsum(fresh) - 1)[order]
        self.firsts = np.searchsorted(self.holders[order], np.arange(len(documents) + 1))

    def ranked(self, document: int, unused: np.ndarray) -> np.ndarray:
        """Unused documents that share a term with a document, best first."""
        terms = self.terms[self.firsts[document]:self.firsts[document + 1]]
        starts = self.starts[terms]
        sizes = self.starts[terms + 1] - starts
        ends = np.cumsum(sizes)
        if not len(ends):
            return ends
        places = np.arange(ends[-1]) + np.repeat(starts - (ends - sizes), sizes)
        scores = np.bincount(self.holders[places], weights=self.impact[places], minlength=self.count)
        found = np.flatnonzero(unused & (scores > 0))
        return found[np.argsort(-scores[found], kind="stable")]


@dataclass
class Piece:
    document: int
    start: int
    length: int
    sequence: int
    offset: int


def packed(sizes: list[int], ranked: Callable[[int, np.ndarray], np.ndarray], sequence: int) -> list[Piece]:
    """Pieces of one shard's documents; all sequences but the last are full.

    ``ranked`` gives the unused neighbours of a document, best first.
    """
    unused = np.ones(len(sizes), dtype=bool)
    out: list[Piece] = []
    number, filled = 0, 0

    def put(document: int, start: int) -> int:
        """Puts a document from ``start`` on until the sequence is full; returns where it stopped."""
        nonlocal number, filled
        length = min(sizes[document] - start, sequence - filled)
        out.append(Piece(document, start, length, number, filled))
        filled += length
        if filled == sequence:
            number, filled = number + 1, 0
        return start + length

    turn, seed, reached = 0, None, 0
    while True:
        if seed is None:
            while turn < len(sizes) and not unused[turn]:
                turn += 1
            if turn == len(sizes):
                return out
            seed, reached = turn, 0
            unused[seed] = False
        while reached < sizes[seed]:
            reached = put(seed, reached)
        rest = None
        if filled:
            for other in ranked(seed, unused).tolist():
                unused[other] = False
                reached = put(other, 0)
                if filled == 0:
                    rest = other if reached < sizes[other] else None
                    break
        seed = rest


def in_powers(pieces: list[Piece], sequence: int) -> list[Piece]:
    """The pieces with a last, unfilled sequence cut into ones of a power of two."""
    if not pieces:
        return pieces
    last = pieces[-1].sequence
    size = sum(piece.length for piece in pieces if piece.sequence == last)
    if size & (size - 1) == 0 or size == sequence:
        return pieces
    out = [piece for piece in pieces if piece.sequence != last]
    number, offset, room = last, 0, 1 << (size.bit_length() - 1)
    left = size
    for piece in pieces[len(out):]:
        done = 0
        while done < piece.length:
            take = min(piece.length - done, room - offset)
            out.append(Piece(piece.document, piece.start + done, take, number, offset))
            done, offset, left = done + take, offset + take, left - take
            if offset == room and left:
                number, offset, room = number + 1, 0, 1 << (left.bit_length() - 1)
    return out


def pack(found: Corpus, *, sequence: int = SEQUENCE, shard_tokens: int = SHARD_TOKENS) -> DataFrame:
    """One row per piece: its document, its place there and in its sequence, and its ids.

    Columns: ``id``, ``start`` and ``length`` within the document's
    ``doc_tokens``, ``sequence_id``, ``offset`` in the sequence, and ``ids`` as
    little-endian 32-bit integers.
    """
    spark = found.tokens.sparkSession
    shared = spark.sparkContext.broadcast(found.weights)
    mean, width = found.mean, found.width
    schema = T.StructType([found.tokens.schema["id"], *PIECES.fields])
    shape = to_arrow_schema(schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        weights = shared.value
        current, number, held, names, documents = None, 0, 0, [], []

        def done() -> pa.RecordBatch:
            nonlocal number, held, names, documents
            index = Index(documents, weights, mean)
            pieces = in_powers(packed([len(ids) for ids in documents], index.ranked, sequence), sequence)
            columns = [
                pa.array([names[p.document] for p in pieces], type=shape.field(0).type),
                pa.array([p.start for p in pieces], pa.int64()),
                pa.array([p.length for p in pieces], pa.int64()),
                pa.array([len(documents[p.document]) for p in pieces], pa.int64()),
                pa.array([(current << 32) + number + p.sequence for p in pieces], pa.int64()),
                pa.array([p.offset for p in pieces], pa.int64()),
                pa.array([documents[p.document][p.start:p.start + p.length].astype("<u4").tobytes() for p in pieces],
                         pa.binary())]
            number += pieces[-1].sequence + 1
            held, names, documents = 0, [], []
            return pa.RecordBatch.from_arrays(columns, schema=shape)

        for batch in batches:
            for name, ids, shard in zip(*(batch.column(k) for k in ("id", "ids", "shard"))):
                shard, ids = shard.as_py(), np.frombuffer(ids.as_buffer(), dtype=width)
                if documents and (shard != current or held + len(ids) > 2 * shard_tokens):
                    yield done()
                if shard != current:
                    current, number = shard, 0
                names.append(name.as_py())
                documents.append(ids)
                held += len(ids)
        if documents:
            yield done()
        give_back()

    dealt = sharded(keyed(found), shard_tokens).select("id", "ids", "shard", "key", "row")
    return dealt.repartition("shard").sortWithinPartitions("shard", "key", "row").mapInArrow(run, schema)
