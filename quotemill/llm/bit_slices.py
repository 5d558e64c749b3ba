"""Exact top-k inner products on a bit-sliced index.

Components are quantised to integers. A block of rows stores each component as
bit slices: slice b of component d is a bitmap of the rows whose value has bit
b. A query's score is a weighted sum of components, and it is computed for all
rows of a block at once by adding slices as bitmaps with carries: for each bit
of the weights, from the highest down, the running sum is doubled and the
components whose weight has the bit are added. Negative weights add the
complement, which shifts all scores of a query alike.

The score's own slices then give the best rows from the most significant slice
downward (O'Neil and Quass): rows with the bit set beat those without, as long
as there are not more of them than places left. What remains tied on every
slice is the boundary; it is resolved exactly, by the smaller id. Scores are
recomputed as integers for the chosen rows alone, whose components are read
back from the slices.

Rows are dealt to blocks by hash, and a block's index is built once, as a row of
a table in the shared folder: the ids, and the slices, which are all that is
known of the vectors from then on (nine bits a component instead of 64). Queries
are dealt to chunks and each task holds one block's index and one chunk,
whatever the table's size. Queries are copied to every block and indexes to
every chunk; no pair of row and query leaves a task except the k best of a
block, which a second step merges. Bitmaps are long, so that a step of an
addition works on many rows at once.

Vectors that are null, or hold null or non-finite components, take no part. A
component that does not fit 64 bits after quantising, or a chosen score that does
not, is an error; within that, scores are exact whatever their size. Rows of equal id and vector count
once; a query never meets rows of its own id. Vectors of different lengths are
compared as if the shorter were filled up with zeros. A query with fewer than k
candidates gets them all; an empty table gives no rows.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quotemill.llm.common import saved

# Rows of a block and queries of a chunk, on average.
BLOCK_ROWS = 131_072
CHUNK_QUERIES = 8_192
# Queries a chunk holds at least before it is made smaller for the sake of cores.
LEAST_QUERIES = 64
# Bits of an index, at 16 a component.
INDEX_BITS = 1 << 29
SCALE = 256
# Quantised components fit 64 bits.
LARGEST = 2.0 ** 63

Slices = list[np.ndarray]


def quantised(vector: Column, scale: int = SCALE) -> Column:
    """floor(scale * x) of each component, or null if the vector takes no part."""
    scaled = F.transform(vector, lambda x: F.lit(scale) * x.cast("double"))
    # Not-a-number is above infinity.
    finite = F.forall(vector, lambda x: x.isNotNull() & (F.abs(x.cast("double")) < F.lit(float("inf"))))
    fits = F.forall(scaled, lambda x: (x >= -LARGEST) & (x < LARGEST))
    error = F.raise_error(F.lit("a quantised component does not fit 64 bits")).cast("array<bigint>")
    return F.when(finite & fits, F.transform(scaled, lambda x: F.floor(x).cast("bigint"))).when(finite, error)


def bitmaps(values: np.ndarray, bits: int) -> Slices:
    """Slices of non-negative values, lowest first, rows packed 64 to a word."""
    padded = np.zeros(-(-len(values) // 64) * 64, dtype=np.uint64)
    padded[:len(values)] = values
    return [
        np.packbits((padded >> np.uint64(bit) & np.uint64(1)).astype(np.uint8), bitorder="little").view(np.uint64)
        for bit in range(bits)]


def added(total: Slices, slices: Slices) -> Slices:
    """Bitmap sum of two sliced numbers, with ripple carries."""
    longer, shorter = (total, slices) if len(total) >= len(slices) else (slices, total)
    out: Slices = []
    carry = None
    for place, x in enumerate(longer):
        if place < len(shorter):
            y = shorter[place]
            half = x ^ y
            if carry is None:
                out.append(half)
                carry = x & y
            else:
                out.append(half ^ carry)
                carry = (x & y) | (half & carry)
        elif carry is None:
            out.append(x)
        else:
            out.append(x ^ carry)
            carry = x & carry
    if carry is not None and carry.any():
        out.append(carry)
    return out


def count(bitmap: np.ndarray) -> int:
    return int(np.bitwise_count(bitmap).sum())


def members(bitmap: np.ndarray) -> np.ndarray:
    return np.flatnonzero(np.unpackbits(bitmap.view(np.uint8), bitorder="little"))


class Block:
    """Bit-sliced index of some rows, in order of their ids."""

    def __init__(self, ids: np.ndarray, low: int, slices: np.ndarray):
        """``slices`` has a bitmap for each component and bit, of values less ``low``."""
        self.ids, self.low, self.slices = ids, low, slices
        self.bits = slices.shape[1]
        self.present = bitmaps(np.ones(len(ids), dtype=np.uint64), 1)[0]
        self.complements = ~slices & self.present
        self.largest = max(abs(low), abs(low + (1 << self.bits) - 1))

    @classmethod
    def of(cls, ids: np.ndarray, vectors: np.ndarray) -> Block:
        order = np.argsort(ids, kind="stable")
        vectors = vectors[order].astype(np.int64)
        low, high = (int(vectors.min()), int(vectors.max())) if vectors.size else (0, 0)
        # Values are shifted to start at 0; the shift is the same for all rows.
        bits = max(1, (high - low).bit_length())
        shifted = vectors.view(np.uint64) - np.uint64(low % (1 << 64))
        words = -(-len(ids) // 64)
        slices = np.empty((vectors.shape[1], bits, words), dtype=np.uint64)
        for place, column in enumerate(shifted.T):
            slices[place] = bitmaps(column, bits)
        return cls(ids[order], low, slices)

    def values(self, rows: np.ndarray) -> list[list[int]]:
        """Components of some rows, read back from the slices."""
        held = self.slices[:, :, rows // 64] >> (rows % 64).astype(np.uint64) & np.uint64(1)
        places = np.uint64(1) << np.arange(self.bits, dtype=np.uint64)
        whole = (held * places[None, :, None]).sum(axis=1, dtype=np.uint64)
        return [[int(x) + self.low for x in row] for row in whole.T.tolist()]

    def score(self, query: np.ndarray) -> Slices:
        """Slices of the query's scores, less a constant common to all rows."""
        total: Slices = []
        # Components that the block lacks are zero.
        weights = [abs(int(w)) for w in query[:len(self.slices)]]
        for bit in reversed(range(max((w.bit_length() for w in weights), default=0))):
            if total:
                total = [np.zeros_like(self.present), *total]
            for place, weight in enumerate(weights):
                if weight >> bit & 1:
                    source = self.slices if query[place] > 0 else self.complements
                    total = added(total, list(source[place]))
        return total

    def exact(self, rows: np.ndarray, query: np.ndarray) -> np.ndarray:
        """Scores of some rows, as Python's integers, whatever their size."""
        weights = [int(w) for w in query]
        scores = [sum(x * w for x, w in zip(vector, weights)) for vector in self.values(rows)]
        if any(not -(1 << 63) <= score < 1 << 63 for score in scores):
            raise OverflowError("a score does not fit 64 bits")
        return np.array(scores, dtype=np.int64)

    def best(self, own: int, query: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
        """Ids and scores of the k best rows, ties by smaller id."""
        open_rows = self.present.copy()
        first, last = np.searchsorted(self.ids, [own, own + 1])
        for row in range(first, last):
            open_rows[row // 64] &= ~np.uint64(1 << row % 64)
        chosen = np.zeros_like(open_rows)
        taken = 0
        for s in reversed(self.score(query)):
            if count(open_rows) <= k - taken:
                break
            ones = open_rows & s
            size = count(ones)
            if size <= k - taken:
                chosen |= ones
                taken += size
                open_rows &= ~s
            else:
                open_rows = ones
        # Rows are in order of id, so the first of the tied rows are the smaller ids.
        rows = np.concatenate([members(chosen), members(open_rows)[:k - taken]])
        scores = self.exact(rows, query)
        # The complement is in reverse order, also of the smallest integer.
        order = np.lexsort((self.ids[rows], ~scores))
        return self.ids[rows][order], scores[order]


def matrix(vectors: pa.Array, width: int) -> np.ndarray:
    """Rows of equal width from a list column, filled up with zeros."""
    flat = vectors.flatten().to_numpy(zero_copy_only=False)
    sizes = vectors.value_lengths().to_numpy(zero_copy_only=False)
    out = np.zeros((len(vectors), width), dtype=np.int64)
    row = np.repeat(np.arange(len(sizes)), sizes)
    column = np.arange(len(flat)) - np.repeat(np.cumsum(sizes) - sizes, sizes)
    out[row, column] = flat
    return out


def width_of(vectors: pa.Array) -> int:
    return int(max(vectors.value_lengths().to_numpy(zero_copy_only=False), default=0)) if len(vectors) else 0


INDEX = "block int, ids binary, low bigint, width int, bits int, slices binary"


def indexed(rows: pa.Table) -> pa.Table:
    """One row: the index of a block's rows."""
    own = rows["vector"].combine_chunks()
    block = Block.of(rows["vec_id"].to_numpy(), matrix(own, width_of(own)))
    return pa.table({
        "block": pa.array([rows["block"][0].as_py()], pa.int32()), "ids": [block.ids.astype("<i8").tobytes()],
        "low": pa.array([block.low], pa.int64()), "width": pa.array([block.slices.shape[0]], pa.int32()),
        "bits": pa.array([block.bits], pa.int32()), "slices": [block.slices.astype("<u8").tobytes()]})


def searched(k: int):
    """Function of one grid cell: the k best rows of its block for each of its queries."""

    def cell(index: pa.Table, queries: pa.Table) -> pa.Table:
        ids: list[int] = []
        found: list[int] = []
        scores: list[int] = []
        if len(index) and len(queries):
            (row,) = index.to_pylist()
            block = Block(
                np.frombuffer(row["ids"], "<i8"), row["low"],
                np.frombuffer(row["slices"], "<u8").reshape(row["width"], row["bits"], -1))
            asked = queries["vector"].combine_chunks()
            for query_id, query in zip(queries["vec_id"].to_pylist(), matrix(asked, width_of(asked))):
                best, values = block.best(query_id, query, k)
                ids += [query_id] * len(best)
                found += best.tolist()
                scores += values.tolist()
        return pa.table({
            "query_id": pa.array(ids, pa.int64()), "vec_id": pa.array(found, pa.int64()),
            "score": pa.array(scores, pa.int64())})

    return cell


def top_k(
    vectors: DataFrame, is_query: Column, k: int, *, id_col: str = "vec_id", vector_col: str = "embedding",
    block_rows: int = BLOCK_ROWS, chunk_queries: int = CHUNK_QUERIES,
) -> DataFrame:
    """The k best rows for every query row, by inner product of quantised vectors.

    Columns: ``query_id``, ``rank`` from 1, ``vec_id``, ``score``.
    """
    # Counted, indexed and asked, so quantised once.
    rows = saved(
        vectors.select(
            F.col(id_col).cast("bigint").alias("vec_id"), quantised(F.col(vector_col)).alias("vector"),
            F.coalesce(is_query, F.lit(False)).alias("asks"))
        .where("vec_id is not null and vector is not null")
        .dropDuplicates(["vec_id", "vector"]))
    sizes = rows.agg(
        F.count(F.lit(1)).alias("rows"), F.count_if("asks").alias("queries"), F.max(F.size("vector")).alias("width")).first()
    # An index is one row of a table, so long vectors make smaller blocks.
    block_rows = max(1, min(block_rows, INDEX_BITS // (16 * max(1, sizes.width or 1))))
    blocks, chunks = max(1, -(-sizes.rows // block_rows)), max(1, -(-sizes.queries // chunk_queries))
    # A small table has few blocks; smaller chunks then give every core a cell.
    cores = vectors.sparkSession.sparkContext.defaultParallelism
    chunks = max(chunks, min(-(-2 * cores // blocks), -(-sizes.queries // LEAST_QUERIES)))

    def dealt(name: str, parts: int) -> Column:
        return F.pmod(F.xxhash64(F.lit(name), "vec_id", "vector"), F.lit(parts)).cast("int")

    def all_of(parts: int) -> Column:
        return F.explode(F.sequence(F.lit(0), F.lit(parts - 1)))

    placed = rows.select("vec_id", "vector", dealt("block", blocks).alias("block"))
    index = saved(placed.groupBy("block").applyInArrow(indexed, INDEX))
    candidates = index.withColumn("chunk", all_of(chunks))
    queries = rows.where("asks").select(
        "vec_id", "vector", dealt("chunk", chunks).alias("chunk"), all_of(blocks).alias("block"))
    found = candidates.groupBy("block", "chunk").cogroup(queries.groupBy("block", "chunk")).applyInArrow(
        searched(k), "query_id bigint, vec_id bigint, score bigint")
    best_first = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return (
        found.withColumn("rank", F.row_number().over(best_first)).where(F.col("rank") <= k)
        .select("query_id", "rank", "vec_id", "score"))
