"""Near duplicates by b-bit MinHash.

A document's set are its distinct shingles of five words; shorter documents are
one shingle. Equal sets form a class, and everything after that works on one
representative per class. Each class has 128 minima. Full minima make the band
keys that bring candidates together; of the rest only the low ``BITS`` bits are
kept, as bit planes in packed words. Two signatures agree where no plane
differs, a bit count; corrected for the minima whose low bits agree by accident,
the share of agreeing positions estimates the similarity, and candidates well
below the threshold go no further. The others are confirmed on their full sets.

Links are found in rounds that never pair all members of a bucket:

1. every member of a bucket against the bucket's smallest member;
2. in wide buckets that still hold several components, every member against a
   member chosen by hash, so a large group meets many different ones;
3. what is left open: members outside their bucket's largest component against
   all members of other components, in a grid of blocks: those that ask are cut
   into blocks as well as those that are asked, and a cell of the grid holds one
   block of each. A semi-join by estimate finds the members that any comparison
   can concern; a task then holds a cell with its sets and returns links alone,
   so no pair that fails is ever a row. However wide a bucket, a cell is as
   large; there are more of them.

After each round linked classes become one component (alternating large-star
and small-star steps), and members of one component are not compared again. A
link is missed only if two sets of at least the threshold share no band (5e-6 at
0.75, less above) or estimate five standard deviations low.

Classes are named by a 64-bit hash of their set. ``component_id`` is the smallest
id reachable, over classes of equal sets too. Null and empty texts have no
shingles, and are linked with nothing. Null ids are never the smallest unless
all of a component are null. Repeated rows give repeated rows with equal
results; an empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from functools import lru_cache, reduce

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_type

from quotemill.llm.common import give_back, saved, unused

SHINGLE = 5
SIMILARITY = 75
HASHES, BANDS, BITS = 128, 32, 4
ROWS = HASHES // BANDS
WORDS_PER_PLANE = HASHES // 64
SEED = 20_240_229
# Standard deviations by which an estimate may fall short and still be confirmed.
SLACK = 5
# Shingles hashed at a time, which bounds a task's memory whatever the texts.
CHUNK = 1 << 19
# Members of a block at most, comparisons of a bucket before members are chosen by hash in it.
BLOCK, WORK = 512, 1_000_000
# Share of a block that is filled on average, as members are dealt by hash.
FILL = 0.75
# Rounds in which wide buckets choose a member by hash.
PIVOTS = 2
# Classes whose texts or sets are picked out by a broadcast of 8 bytes each; more are joined.
FEW = 1_000_000

# Odd multipliers that make a shingle's hash depend on the order of its words.
ORDER = np.array(
    [0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0xD6E8FEB86659FD93, 0xA0761D6478BD642F],
    dtype=np.uint64)
MIX = np.uint64(0xBF58476D1CE4E5B9)


def shingle_hashes(text: str | None) -> np.ndarray:
    """Hashes of a text's distinct shingles, in ascending order."""
    words = (text or "").encode("utf-8", "surrogatepass").lower().split()
    if not words:
        return np.zeros(0, dtype=np.uint64)
    hashes = np.fromiter(map(xxhash.xxh3_64_intdigest, words), dtype=np.uint64, count=len(words))
    width = min(SHINGLE, len(words))
    size = len(words) - width + 1
    mixed = np.full(size, width, dtype=np.uint64)
    for place in range(width):
        mixed += hashes[place:place + size] * ORDER[place]
    mixed ^= mixed >> np.uint64(29)
    mixed *= MIX
    mixed ^= mixed >> np.uint64(32)
    return np.unique(mixed)


@lru_cache(maxsize=1)
def permutations() -> tuple[np.ndarray, np.ndarray]:
    random = np.random.default_rng(SEED)
    factors = random.integers(0, 1 << 63, HASHES, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
    return factors, random.integers(0, 1 << 63, HASHES, dtype=np.uint64)


def minima(sets: list[np.ndarray]) -> np.ndarray:
    """Minima of non-empty sets, one row per set."""
    factors, terms = permutations()
    flat = np.concatenate(sets)
    starts = np.cumsum([0] + [len(s) for s in sets[:-1]])
    out = np.empty((len(sets), HASHES), dtype=np.uint64)
    room = np.empty_like(flat)
    for place in range(HASHES):
        np.multiply(flat, factors[place], out=room)
        np.add(room, terms[place], out=room)
        out[:, place] = np.minimum.reduceat(room, starts)
    return out


def planes(mins: np.ndarray) -> np.ndarray:
    """Low bits of the minima: plane by plane, 64 minima to a word."""
    words = [
        np.packbits((mins >> np.uint64(bit) & np.uint64(1)).astype(np.uint8), axis=1, bitorder="little").view(np.int64)
        for bit in range(BITS)]
    return np.concatenate(words, axis=1)


def band_keys(mins: np.ndarray) -> np.ndarray:
    """A key per band, different between bands."""
    keys = np.broadcast_to(np.arange(1, BANDS + 1, dtype=np.uint64) * ORDER[0], (len(mins), BANDS)).copy()
    grouped = mins.reshape(len(mins), BANDS, ROWS)
    for row in range(ROWS):
        keys = (keys ^ grouped[:, :, row]) * MIX
        keys ^= keys >> np.uint64(31)
    return keys.view(np.int64)


SIGNATURE = T.StructType([
    T.StructField("n_shingles", T.LongType()),
    T.StructField("node", T.LongType()),
    T.StructField("planes", T.ArrayType(T.LongType())),
    T.StructField("bands", T.ArrayType(T.LongType())),
])


def node_of(hashes: np.ndarray) -> int:
    return xxhash.xxh3_64_intdigest(hashes.tobytes()) - (1 << 63)


def signatures() -> Callable[..., Column]:
    """Column function: text to its set's size, class, bit planes and band keys."""
    kind = to_arrow_type(SIGNATURE)

    def signed(sets: list[np.ndarray]) -> list[dict]:
        filled = [s for s in sets if len(s)]
        rows = iter(())
        if filled:
            mins = minima(filled)
            rows = iter(zip(planes(mins).tolist(), band_keys(mins).tolist()))
        out = []
        for s in sets:
            bits, bands = next(rows) if len(s) else (None, None)
            out.append({
                "n_shingles": len(s), "node": node_of(s) if len(s) else None, "planes": bits, "bands": bands})
        return out

    def run(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for batch in batches:
            out: list[pa.Array] = []
            sets: list[np.ndarray] = []
            held = 0
            for value in batch:
                sets.append(shingle_hashes(value.as_py()))
                held += len(sets[-1])
                if held >= CHUNK:
                    out.append(pa.array(signed(sets), type=kind))
                    sets, held = [], 0
            out.append(pa.array(signed(sets), type=kind))
            yield pa.concat_arrays(out)
        give_back()

    return F.arrow_udf(run, SIGNATURE)


def shingles() -> Callable[..., Column]:
    """Column function: text to its class and its set, as signed hashes."""
    shape = T.StructType([
        T.StructField("node", T.LongType()), T.StructField("shingles", T.ArrayType(T.LongType()))])
    kind = to_arrow_type(shape)

    def run(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for batch in batches:
            sets = [shingle_hashes(value.as_py()) for value in batch]
            offsets = pa.array(np.cumsum([0] + [len(s) for s in sets]), pa.int32())
            flat = np.concatenate(sets).view(np.int64) if sets else np.zeros(0, np.int64)
            yield pa.StructArray.from_arrays(
                [pa.array([node_of(s) for s in sets], pa.int64()), pa.ListArray.from_arrays(offsets, flat)],
                fields=list(kind))
        give_back()

    return F.arrow_udf(run, shape)


def agreeing(left: Column, right: Column) -> Column:
    """Positions at which two signatures agree on all planes."""
    differing = [
        F.bit_count(reduce(
            lambda x, y: x.bitwiseOR(y),
            [left[plane * WORDS_PER_PLANE + word].bitwiseXOR(right[plane * WORDS_PER_PLANE + word])
             for plane in range(BITS)]))
        for word in range(WORDS_PER_PLANE)]
    return F.lit(HASHES) - reduce(lambda x, y: x + y, differing)


def estimate(left: Column, right: Column) -> Column:
    """Similarity of two sets, corrected for positions that agree by accident."""
    accident = 2.0 ** -BITS
    return (agreeing(left, right) / HASHES - accident) / (1 - accident)


def least_estimate(similarity: int) -> float:
    """Estimates below this are too low for the similarity, in percent, by ``SLACK`` deviations."""
    accident = 2.0 ** -BITS
    share = accident + (1 - accident) * similarity / 100
    return similarity / 100 - SLACK * (share * (1 - share) / HASHES) ** 0.5 / (1 - accident)


def may_link(left: str, right: str, similarity: int) -> Column:
    """Whether two frames' rows, with ``n`` and ``planes``, can be similar enough."""
    a, b = F.col(f"{left}.n"), F.col(f"{right}.n")
    return (100 * F.least(a, b) >= similarity * F.greatest(a, b)) & (
        estimate(F.col(f"{left}.planes"), F.col(f"{right}.planes")) >= least_estimate(similarity))


def components(links: DataFrame) -> DataFrame:
    """Node and smallest node of its component, for all linked nodes but the smallest.

    Alternates large-star and small-star steps until all edges lead to a node
    that has no smaller neighbour. A node with very many links is combined
    before the shuffle that finds its smallest neighbour; the join back is
    split by the optimizer where it is skewed.
    """
    edges = links.select(F.greatest("a", "b").alias("x"), F.least("a", "b").alias("y")).where("x <> y")
    while True:
        both = edges.unionByName(edges.select(F.col("y").alias("x"), F.col("x").alias("y")))
        smallest = both.groupBy("x").agg(F.least(F.min("y"), F.col("x")).alias("m"))
        large = both.join(smallest, "x").where("y > x").select(F.col("y").alias("x"), F.col("m").alias("y"))
        smallest = large.groupBy("x").agg(F.min("y").alias("m"))
        small = large.join(smallest, "x").select(
            F.explode(F.array(F.struct("x", F.col("m").alias("y")), F.struct(F.col("y").alias("x"), F.col("m").alias("y"))))
            .alias("e")).select("e.*")
        edges = saved(small.where("x <> y").distinct())
        ends = edges.select(F.explode(F.array(
            F.struct(F.col("x").alias("node"), F.lit(1).alias("above"), F.lit(0).alias("below")),
            F.struct(F.col("y").alias("node"), F.lit(0).alias("above"), F.lit(1).alias("below")))).alias("e"))
        open_nodes = ends.groupBy("e.node").agg(F.sum("e.above").alias("above"), F.max("e.below").alias("below"))
        if open_nodes.where("above > 1 or (above > 0 and below > 0)").isEmpty():
            return edges.select(F.col("x").alias("node"), F.col("y").alias("label"))


def few(keys: DataFrame) -> DataFrame:
    """The keys, marked for a broadcast if there are at most ``FEW`` of them."""
    return F.broadcast(keys) if keys.count() <= FEW else keys


def too_wide() -> Column:
    """Whether an open bucket is compared with members chosen by hash before all others."""
    return (F.col("all") - F.col("top")) * F.col("all") > WORK


class Search:
    """Finds the links between classes, round by round."""

    def __init__(self, docs: DataFrame, reps: DataFrame, similarity: int):
        self.docs, self.reps, self.similarity = docs, reps, similarity
        self.light = reps.select("node", "n", "planes")
        keys = reps.select("node", F.explode("bands").alias("bucket"))
        shared = keys.groupBy("bucket").agg(
            F.count(F.lit(1)).alias("members"), F.min("node").alias("centre")).where("members > 1")
        self.members = saved(keys.join(shared.select("bucket", "centre"), "bucket"))
        self.sets = self.sets_of(self.members.select("node").distinct())
        self.links = None

    def sets_of(self, nodes: DataFrame) -> DataFrame:
        """Full sets of some classes, from the texts that stand for them.

        Texts are recognised by hash. Copies of a text give one row.
        """
        wanted = saved(self.reps.join(nodes, "node", "left_semi").select(F.col("text_hash").alias("_hash")))
        texts = self.docs.select("text", F.xxhash64("text").alias("_hash")).join(few(wanted), "_hash", "left_semi")
        return saved(
            texts.select(shingles()("text").alias("s")).select("s.*")
            .groupBy("node").agg(F.first("shingles").alias("shingles")))

    def confirmed(self, edges: DataFrame) -> DataFrame:
        """The candidate pairs whose full sets are similar enough."""
        a = self.light.select(F.col("node").alias("a"), "n", "planes").alias("l")
        b = self.light.select(F.col("node").alias("b"), "n", "planes").alias("r")
        pairs = saved(
            edges.select("a", "b").distinct()
            .join(a, "a").join(b, "b").where(may_link("l", "r", self.similarity)).select("a", "b"))
        sets = self.sets_at(pairs.select(F.explode(F.array("a", "b")).alias("node")))
        left = sets.select(F.col("node").alias("a"), F.col("shingles").alias("left"))
        right = sets.select(F.col("node").alias("b"), F.col("shingles").alias("right"))
        common = F.size(F.array_intersect("left", "right"))
        union = F.size("left") + F.size("right") - common
        return (
            pairs.join(left, "a").join(right, "b")
            .where(100 * common >= self.similarity * union).select("a", "b"))

    def sets_at(self, nodes: DataFrame) -> DataFrame:
        """The kept sets of some classes."""
        return self.sets.join(few(saved(nodes.distinct())), "node", "left_semi")

    def add(self, found: DataFrame) -> None:
        """Merges what confirmed pairs link."""
        if self.links is not None:
            found = found.unionByName(self.links.select(F.col("node").alias("a"), F.col("label").alias("b")))
        self.links = components(found)

    def labelled(self, rows: DataFrame) -> DataFrame:
        """Rows with their node's component."""
        return rows.join(self.links, "node", "left").withColumn("label", F.coalesce("label", "node"))

    def opened(self, rows: DataFrame) -> DataFrame:
        """Members of buckets that hold several components, with the buckets' sizes."""
        sizes = (
            rows.groupBy("bucket", "label").agg(F.count(F.lit(1)).alias("size"))
            .groupBy("bucket").agg(
                F.sum("size").alias("all"), F.max("size").alias("top"), F.max_by("label", "size").alias("major"))
            .where("all > top"))
        return saved(rows.join(sizes, "bucket"))

    def run(self) -> DataFrame:
        """Node and component of every linked class."""
        members = self.members.select("bucket", "node")
        self.add(self.confirmed(
            self.members.where("node <> centre").select(F.col("centre").alias("a"), F.col("node").alias("b"))))
        opened = self.opened(self.labelled(members))
        for turn in range(PIVOTS):
            wide = opened.where(too_wide())
            if wide.isEmpty():
                break
            order = F.xxhash64(F.lit(turn), "bucket", "node")
            chosen = wide.groupBy("bucket").agg(
                F.max_by("node", order).alias("pivot"), F.max_by("label", order).alias("pivot_label"))
            self.add(self.confirmed(
                wide.join(chosen, "bucket").where("label <> pivot_label")
                .select(F.col("pivot").alias("a"), F.col("node").alias("b"))))
            opened = self.opened(self.labelled(members))
        self.add(self.crossed(opened))
        return self.links

    def crossed(self, opened: DataFrame) -> DataFrame:
        """Members outside the largest component against the bucket, cell by cell.

        Two members that share several buckets meet in the one of their first
        common band.
        """
        rows = self.cells(opened)
        here = rows.alias("l")
        there = rows.alias("r")
        same = reduce(lambda x, y: x & y, [F.col(f"l.{c}") == F.col(f"r.{c}") for c in CELL])
        # Two members that both ask meet twice; the one of the smaller node is enough.
        once = F.when(F.col("l.asks"), ~F.col("r.minor") | (F.col("l.node") < F.col("r.node"))).otherwise(
            ~F.col("l.minor") | (F.col("r.node") < F.col("l.node")))
        other = (F.col("l.asks") != F.col("r.asks")) & (F.col("l.label") != F.col("r.label"))
        first = F.array_position(F.zip_with("l.bands", "r.bands", lambda x, y: x == y), True).cast("int") - 1
        turn = F.col("l.bands")[first] == F.col("l.bucket")
        meeting = saved(
            here.join(there, same & other & once & may_link("l", "r", self.similarity) & turn, "left_semi"))
        return (
            meeting.join(self.sets_at(meeting.select("node")), "node")
            .repartition(*CELL).sortWithinPartitions(*CELL)
            .mapInArrow(linker(self.similarity), "a bigint, b bigint"))

    def cells(self, opened: DataFrame) -> DataFrame:
        """The open buckets' members in the cells of their grids.

        A member stands in one block, in the cells of all blocks that ask; one
        outside the largest component also asks, from one block, in the cells of
        all blocks it stands against. So every asking member meets every other.
        """
        def dealt(seed: int, blocks: str) -> Column:
            return F.pmod(F.xxhash64(F.lit(seed), "node"), F.col(blocks)).cast("int")

        def cell(block: Column, asking: Column, asks: bool) -> Column:
            return F.struct(block.alias("block"), asking.alias("asking"), F.lit(asks).alias("asks"))

        def upto(blocks: str) -> Column:
            return F.sequence(F.lit(0), F.col(blocks) - 1)

        stands = F.transform(upto("asking_blocks"), lambda k: cell(dealt(0, "blocks"), k, False))
        asked = F.transform(upto("blocks"), lambda k: cell(k, dealt(1, "asking_blocks"), True))
        filled = FILL * BLOCK
        return (
            opened.join(self.reps.select("node", "n", "planes", "bands"), "node")
            .withColumns({
                "blocks": F.ceil(F.col("all") / filled).cast("int"),
                "asking_blocks": F.ceil((F.col("all") - F.col("top")) / filled).cast("int"),
                "minor": F.col("label") != F.col("major")})
            .select("bucket", "node", "label", "n", "planes", "bands", "minor", F.explode(
                F.when(F.col("minor"), F.concat(stands, asked)).otherwise(stands)).alias("at"))
            .select("bucket", "at.block", "at.asking", "at.asks", "node", "label", "n", "planes", "bands", "minor"))


# What names a cell of the grids.
CELL = ("bucket", "block", "asking")


def linker(similarity: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """Function of sorted rows: one link for each asking row and component it is similar to, by cell.

    Rows are compared under the same rules that chose them. Only a cell's rows
    are held. Rows of a cell follow each other, possibly in several batches.
    """
    least = least_estimate(similarity)
    accident = 2.0 ** -BITS

    def links(rows: pa.Table) -> list[tuple[int, int]]:
        asks, minor = (rows[c].to_numpy() for c in ("asks", "minor"))
        node, label, n = (rows[c].to_numpy() for c in ("node", "label", "n"))
        bits = rows["planes"].combine_chunks().flatten().to_numpy().view(np.uint64).reshape(
            len(node), BITS, WORDS_PER_PLANE)
        bands = rows["bands"].combine_chunks().flatten().to_numpy().reshape(len(node), BANDS)
        bucket = rows["bucket"][0].as_py()
        shingles = rows["shingles"].combine_chunks()
        flat = shingles.flatten().to_numpy().view(np.uint64)
        ends = np.cumsum(shingles.value_lengths().to_numpy())
        starts = ends - n
        out = []
        for row in np.flatnonzero(asks):
            differing = np.bitwise_or.reduce(bits ^ bits[row], axis=1)
            agreeing = HASHES - np.bitwise_count(differing).sum(axis=1, dtype=np.int64)
            may = (
                ~asks & (label != label[row]) & (~minor | (node > node[row]))
                & (100 * np.minimum(n, n[row]) >= similarity * np.maximum(n, n[row]))
                & ((agreeing / HASHES - accident) / (1 - accident) >= least))
            others = np.flatnonzero(may)
            common = bands[others] == bands[row]
            others = others[bands[row][common.argmax(axis=1)] == bucket]
            if not len(others):
                continue
            own = flat[starts[row]:ends[row]]
            values = np.concatenate([flat[starts[k]:ends[k]] for k in others])
            at = np.minimum(np.searchsorted(own, values), len(own) - 1)
            firsts = np.cumsum(n[others]) - n[others]
            common = np.add.reduceat((own[at] == values).astype(np.int64), firsts)
            similar = others[100 * common >= similarity * (n[row] + n[others] - common)]
            reached = np.unique(label[similar], return_index=True)[1]
            out += [(int(node[row]), int(node[similar[k]])) for k in reached]
        return out

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = None
        for batch in batches:
            table = pa.Table.from_batches([batch])
            table = table if held is None else pa.concat_tables([held, table])
            places = [table[name].to_numpy() for name in CELL]
            borders = np.flatnonzero(np.any([place[1:] != place[:-1] for place in places], axis=0)) + 1
            found = []
            for start, end in zip([0, *borders], borders):
                found += links(table.slice(start, end - start))
            # The last cell may go on in the next batch.
            held = table.slice(borders[-1] if len(borders) else 0)
            yield packed(found)
        if held is not None and len(held):
            yield packed(links(held))
        del held
        give_back()

    def packed(found: list[tuple[int, int]]) -> pa.RecordBatch:
        return pa.RecordBatch.from_pydict({
            "a": pa.array([a for a, _ in found], pa.int64()), "b": pa.array([b for _, b in found], pa.int64())})

    return run


def assigned(docs: DataFrame, id_col: str, text_col: str, similarity: int) -> DataFrame:
    """Per document: id, text hash, set size, component (null without shingles) and the component's id."""
    texts = docs.select(F.col(f"`{id_col}`").alias("id"), F.col(f"`{text_col}`").alias("text"))
    signed = saved(texts.select(
        "id", F.xxhash64("text").alias("text_hash"), signatures()("text").alias("s")).select("id", "text_hash", "s.*"))
    reps = saved(
        signed.where("node is not null").groupBy("node").agg(
            F.min("id").alias("first_id"), F.min("text_hash").alias("text_hash"),
            F.max("n_shingles").alias("n"), F.first("planes").alias("planes"), F.first("bands").alias("bands")))
    linked = Search(texts, reps, similarity).run()
    classes = reps.select("node", "first_id").join(linked, "node", "left").withColumn(
        "label", F.coalesce("label", "node"))
    smallest = classes.groupBy("label").agg(F.min("first_id").alias("component_id"))
    named = classes.join(smallest, "label").select("node", "label", "component_id")
    return signed.select("id", "text_hash", "n_shingles", "node").join(named, "node", "left")


def near_duplicates(
    docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", similarity: int = SIMILARITY,
) -> DataFrame:
    """Component of near duplicates of every document.

    Columns: the id, ``n_shingles``, ``component_id`` (smallest id reachable)
    and ``kept`` (whether the id is the component's). ``similarity`` is in percent.
    """
    component = F.when(F.col("label").isNull(), F.col("id")).otherwise(F.col("component_id"))
    return assigned(docs, id_col, text_col, similarity).select(
        F.col("id").alias(id_col), "n_shingles", component.alias("component_id"),
        F.col("id").eqNullSafe(component).alias("kept"))


def one_of_each(
    docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", similarity: int = SIMILARITY,
) -> DataFrame:
    """The documents with one row of each component, all columns as they were.

    Of a component the smallest id stays, rows without an id last. Documents
    without shingles are in no component and all stay, repeated rows once. Of
    rows with equal id and text one stays, also if they differ elsewhere.
    """
    rows = saved(assigned(docs, id_col, text_col, similarity))
    first = F.min(F.struct(F.col("id").isNull(), "id", "text_hash")).alias("first")
    chosen = rows.where("label is not null").groupBy("label").agg(first).select("first.id", "first.text_hash")
    alone = rows.where("label is null").select("id", "text_hash").distinct()
    kept = chosen.unionByName(alone).withColumnsRenamed({"id": "__kept_id", "text_hash": "__kept_hash"})
    number, text = F.col(f"`{id_col}`"), F.col(f"`{text_col}`")
    same = number.eqNullSafe(F.col("__kept_id")) & (F.xxhash64(text) == F.col("__kept_hash"))
    stay = docs.join(kept, same, "left_semi")
    repeated = rows.groupBy("id", "text_hash").agg(F.count(F.lit(1)).alias("n")).where("n > 1")
    if repeated.isEmpty():
        return stay
    # Rows of equal id and text cannot be told apart by what is kept.
    own = [unused(docs, name) for name in ("__id", "__hash")]
    return (
        stay.withColumns({own[0]: number, own[1]: F.xxhash64(text)}).dropDuplicates(own)
        .select(*[F.col(f"`{name}`") for name in docs.columns]))
