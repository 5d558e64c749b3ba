"""Mixing sources to target weights by a min-cost flow.

A document that stands in several sources, as copies of one text, belongs to all
of them. Texts are aggregated by membership pattern, the set of sources they
stand in, and the flow routes tokens from patterns through their sources to the
sources' quotas. Reading a text again costs more each time (0 for the first
reading, then 1, 2, ..., whichever copy is read), so a pattern has one arc per
reading with rising cost: fresh text is used up before anything is repeated,
across all patterns at once, and copies in one source give way to text that
another source lacks. The flow is as large as quotas and copies allow, at the
least cost; as cost sits on the arcs out of the origin alone, it is found by
maximal flows, one cost after the other.

Patterns, sources, their sizes, weights and targets are tables. Sources that
share no text with another give their target or all their readings, in closed
form. The others fall into connected groups (found like components of near
duplicates); a group is one flow in one task, which holds a number per pair of
pattern and source, never documents. No source or pattern passes the driver.

The flow says how many tokens each pattern gives each source. Whole readings
apply to all its documents there; the rest of a reading goes to documents in the
order of a seeded hash of their id until it is used up. Shared texts stand on a
circle by their hash, and a pattern's sources go around it one after another. Documents are dealt to
buckets by that hash; bucket sums locate the bucket where the rest ends, and only
its documents are put in order, so no task sorts a source. A document is taken
whole, so a pair of pattern and source misses its amount by less than half of
one; a source's own texts make good what its shared ones missed.

Targets are weight shares of all tokens. A source's target stops at
``max_repeats`` times its size, and the excess is shared again by weight among
sources below their cap until none is above.

Null and empty texts have size 0, nothing is taken of them, and they are copies
of nothing. A null source is a source, named last. Rows of equal id and size are
alike in order, and repeated rows are taken each on its own. An empty table gives
no rows. Results depend on the seed and the rows alone, not on their partitioning.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quotemill.llm.common import saved, unused
from quotemill.llm.merkle import placed
from quotemill.llm.near_dups import components

MAX_REPEATS = 3
SEED = 2024
# Decisions that are broadcast (more are joined), and documents of a bucket on average.
FEW_DECISIONS = 20_000
BUCKET_ROWS = 2_000
WHOLE = "bigint"
# Places on the circle of a pattern's texts.
CIRCLE = 1 << 32


def cycled(weights: Sequence[float] = (1, 2, 3)) -> Column:
    """Weights in turn, by a source's place in order."""
    return F.element_at(F.array(*map(F.lit, weights)), (F.col("place") % len(weights) + 1).cast("int"))


def quotas(sizes: Sequence[int], weights: Sequence[float], max_repeats: int = MAX_REPEATS) -> list[float]:
    """Target of each source: its weight's share of all sizes, capped and reshared."""
    target = [0.0] * len(sizes)
    free = [k for k in range(len(sizes)) if weights[k] > 0]
    left = float(sum(sizes))
    while free:
        total = sum(weights[k] for k in free)
        capped = [k for k in free if left * weights[k] / total > max_repeats * sizes[k]]
        if not capped:
            for k in free:
                target[k] = left * weights[k] / total
            break
        for k in capped:
            target[k] = float(max_repeats * sizes[k])
            left -= target[k]
        done = set(capped)
        free = [k for k in free if k not in done]
    return target


class Network:
    """Maximal flow by blocking flows, with room that may be added between runs."""

    def __init__(self, size: int):
        self.arcs: list[list[int]] = [[] for _ in range(size)]
        self.head: list[int] = []
        self.room: list[int] = []

    def arc(self, start: int, end: int, room: int) -> int:
        """Number of the new arc; the next number is its reverse."""
        number = len(self.head)
        for tail, head, free in ((start, end, room), (end, start, 0)):
            self.arcs[tail].append(len(self.head))
            self.head.append(head)
            self.room.append(free)
        return number

    def levels(self, source: int, sink: int) -> list[int] | None:
        """Arcs from the source to each node that room reaches, or None if the sink is not."""
        level = [-1] * len(self.arcs)
        level[source] = 0
        queue = [source]
        for node in queue:
            for number in self.arcs[node]:
                end = self.head[number]
                if self.room[number] and level[end] < 0:
                    level[end] = level[node] + 1
                    queue.append(end)
        return level if level[sink] >= 0 else None

    def fill(self, source: int, sink: int) -> None:
        """Sends as much more as there is room for."""
        while (level := self.levels(source, sink)) is not None:
            turn = [0] * len(self.arcs)
            path: list[int] = []
            node = source
            while True:
                if node == sink:
                    amount = min(self.room[number] for number in path)
                    for number in path:
                        self.room[number] -= amount
                        self.room[number ^ 1] += amount
                    # On from the first arc that is full now.
                    first = next(k for k, number in enumerate(path) if not self.room[number])
                    node = self.head[path[first] ^ 1]
                    del path[first:]
                    continue
                arcs = self.arcs[node]
                while turn[node] < len(arcs):
                    number = arcs[turn[node]]
                    if self.room[number] and level[self.head[number]] == level[node] + 1:
                        break
                    turn[node] += 1
                if turn[node] < len(arcs):
                    path.append(arcs[turn[node]])
                    node = self.head[path[-1]]
                elif path:
                    node = self.head[path.pop() ^ 1]
                    turn[node] += 1
                else:
                    break


def routed(
    fresh: Sequence[int], quotas: Sequence[int], pairs: Sequence[tuple[int, int, int]], max_repeats: int = MAX_REPEATS,
) -> list[int]:
    """Tokens each pair of pattern and source gives, repeats counted.

    ``fresh`` has the tokens of each pattern's texts, ``pairs`` a pattern, a
    source and the tokens of the copies there, each of which may be read
    ``max_repeats`` times.
    """
    network = Network(2 + len(fresh) + len(quotas))
    origin, end = 0, 1
    held = [0] * len(fresh)
    inflow = [network.arc(origin, 2 + k, 0) for k in range(len(fresh))]
    given = []
    for pattern, source, size in pairs:
        given.append(network.arc(2 + pattern, 2 + len(fresh) + source, max_repeats * size))
        held[pattern] += max_repeats * size
    for source, quota in enumerate(quotas):
        network.arc(2 + len(fresh) + source, end, quota)
    for reading in range(max_repeats + 1):
        # Further readings of texts with many copies all cost the same.
        for number, size, most in zip(inflow, fresh, held):
            network.room[number] += min(size, most) if reading < max_repeats else max(0, most - max_repeats * size)
        network.fill(origin, end)
    return [network.room[number ^ 1] for number in given]


def flows(max_repeats: int) -> Callable[[pd.DataFrame], pd.DataFrame]:
    """Function of one group's pairs: what each gives."""
    def solve(group: pd.DataFrame) -> pd.DataFrame:
        # In an order that does not depend on how the rows came.
        group = group.sort_values(["pattern", "key"], ignore_index=True)
        patterns, pattern = group["pattern"].unique(), group["pattern"].factorize()[0]
        sources, source = group["key"].unique(), group["key"].factorize()[0]
        fresh = group.groupby("pattern", sort=False)["fresh"].first().loc[patterns].tolist()
        quotas = group.groupby("key", sort=False)["quota"].first().loc[sources].tolist()
        pairs = list(zip(pattern.tolist(), source.tolist(), group["held"].tolist()))
        amounts = routed([int(x) for x in fresh], [int(x) for x in quotas], [(p, s, int(h)) for p, s, h in pairs], max_repeats)
        return pd.DataFrame({"edge": group["edge"], "amount": amounts})
    return solve


def level_of(sources: DataFrame, max_repeats: int) -> tuple[float, float]:
    """Size and weight, over all sources below their cap, whose ratio times a weight is a target.

    Each step caps the sources above their cap at the last level, which raises
    the level; a handful of steps settle it, each a sum over the sources.
    """
    capped = F.lit(False)
    before = None
    while True:
        size, weight, number = sources.agg(
            F.sum("source_size") - F.coalesce(F.sum(F.when(capped, max_repeats * F.col("source_size"))), F.lit(0)),
            F.coalesce(F.sum(F.when(~capped, F.col("weight"))), F.lit(0)), F.count_if(capped)).first()
        if number == before or not weight:
            return float(size or 0), float(weight)
        before = number
        cap = (max_repeats * F.col("source_size")).cast("double")
        capped = capped | (F.lit(float(size)) * F.col("weight") / F.lit(float(weight)) > cap)


class Mix:
    """Decisions of a mix: how often each document is read.

    ``source`` and ``size`` (its tokens) are columns of ``docs``; rows with
    equal ``same`` and a size are copies of one text. ``weight`` is a column
    over a source's ``place`` in order, from 0, and its ``source``; 1, 2, 3 in
    turn unless given. ``sources`` holds every source with its size and target.
    """

    def __init__(
        self, docs: DataFrame, source: Column, size: Column, same: Column, *, weight: Column | None = None,
        id_col: str = "doc_id", max_repeats: int = MAX_REPEATS, seed: int = SEED,
    ):
        number = F.col(f"`{id_col}`")
        self.source, self.size = source.cast("string"), size.cast(WHOLE)
        # Null ids hash as the empty text.
        named = F.concat_ws(":", F.lit(str(seed)), F.coalesce(number.cast("string"), F.lit("")), self.size.cast("string"))
        self.own = {
            "id": number, "source": self.source, "size": self.size, "rank": F.md5(named),
            # A source's number; the missing one has its own.
            "key": F.coalesce(F.xxhash64(F.lit("s"), self.source), F.lit(0)),
            "t1": F.when(self.size > 0, F.xxhash64(same)), "t2": F.when(self.size > 0, F.xxhash64(F.lit(1), same))}
        rows = saved(docs.select(*[column.alias(name) for name, column in self.own.items()]))
        self.sources = self.targeted(rows, cycled() if weight is None else weight, max_repeats)
        # Texts that stand in several sources, with the number of their set of sources.
        stand = rows.where("t1 is not null").groupBy("t1", "t2", "source", "key").agg(
            F.sum("size").alias("held"), F.max("size").alias("size"))
        sets = stand.groupBy("t1", "t2").agg(
            F.count(F.lit(1)).alias("n"), F.max("size").alias("size"),
            F.xxhash64(F.count(F.lit(1)), F.bit_xor("key"), F.bit_xor(F.xxhash64(F.lit(1), "key"))).alias("pattern"))
        self.shared = saved(sets.where("n > 1").select("t1", "t2", "pattern", "size"))
        placed_rows = saved(self.with_edge(rows))
        pairs = placed_rows.groupBy("edge", "pattern", "key").agg(
            F.sum("size").alias("held"), F.count(F.lit(1)).alias("rows"), F.first("source").alias("source"))
        pairs = saved(pairs.join(self.sources.select("key", F.bround("target").cast(WHOLE).alias("quota")), "key"))
        given = saved(pairs.where("held > 0").join(self.routes(pairs, max_repeats), "edge"))
        self.few = given.count() <= FEW_DECISIONS
        shared = saved(self.decided(placed_rows, given.where("pattern is not null")))
        # What shared texts miss or give too much, as documents are taken whole, a source's own texts make good.
        missed = shared.join(given.select("edge", "key", "amount"), "edge").groupBy("key").agg(
            F.sum(F.col("amount") - F.col("got")).alias("missed"))
        own = given.where("pattern is null").join(missed, "key", "left")
        amount = F.greatest(F.lit(0), F.least(
            F.col("amount") + F.coalesce("missed", F.lit(0)), max_repeats * F.col("held")))
        alone = self.decided(placed_rows, own.withColumn("amount", amount))
        self.decisions = saved(shared.unionByName(alone).drop("got"))

    def decided(self, rows: DataFrame, given: DataFrame) -> DataFrame:
        """How often the documents of each pair are read, and the tokens that makes (``got``).

        A pattern's sources go on where the one before stopped, on a circle of
        its texts in seeded order, so that copies are read in turn.
        """
        fresh = self.shared.groupBy("pattern").agg(F.sum("size").alias("fresh"))
        rest = F.col("amount") % F.col("held")
        before = F.sum("rest").over(
            Window.partitionBy("pattern").orderBy("key").rowsBetween(Window.unboundedPreceding, -1))
        parted = given.withColumn("rest", rest).join(fresh, "pattern", "left")
        shared = parted.where("pattern is not null").withColumn("before", F.coalesce(before, F.lit(0)))
        alone = parted.where("pattern is null").withColumn("before", F.lit(0))
        share = F.pmod(F.col("before"), F.col("fresh")) / F.col("fresh")
        plan = saved(shared.unionByName(alone).select(
            "edge", "held", F.expr("amount div held").alias("whole"), "rest",
            F.ceil(F.col("rows") / BUCKET_ROWS).cast("bigint").alias("buckets"),
            F.floor(share * CIRCLE).alias("offset"), F.ceil(F.col("held") / F.col("fresh")).alias("copies")))
        return cuts(rows, plan, self.small)

    def targeted(self, rows: DataFrame, weight: Column, max_repeats: int) -> DataFrame:
        """Every source with its size and its target."""
        sizes = saved(
            rows.groupBy("source", "key").agg(F.sum("size").alias("source_size"))
            .withColumns({"all": F.lit(0), "last": F.col("source").isNull()}))
        ordered = placed(sizes, "all", ["last", "source"]).withColumnRenamed("pos", "place")
        weighed = saved(ordered.withColumn("weight", weight).select("source", "key", "source_size", "weight"))
        size, total = level_of(weighed, max_repeats)
        share = F.lit(size) * F.col("weight") / F.lit(total) if total else F.lit(float("inf"))
        cap = (max_repeats * F.col("source_size")).cast("double")
        return saved(weighed.select("source", "key", "source_size", F.least(share, cap).alias("target")))

    def with_edge(self, rows: DataFrame) -> DataFrame:
        """Rows with their text's pattern, null where it stands in one source, and the pair of both."""
        shared = self.shared.select("t1", "t2", "pattern")
        return rows.join(F.broadcast(shared) if self.shared.count() <= FEW_DECISIONS else shared, ["t1", "t2"], "left").withColumn(
            "edge", F.xxhash64(F.coalesce("pattern", F.lit(0)), "key"))

    def routes(self, pairs: DataFrame, max_repeats: int) -> DataFrame:
        """What each pair of pattern and source gives."""
        overlap = pairs.where("pattern is not null").select(F.col("pattern").alias("a"), F.col("key").alias("b"))
        # The smallest number of a group is its label and not listed.
        groups = overlap.select(F.col("b").alias("node")).distinct().join(components(overlap), "node", "left").select(
            F.col("node").alias("key"), F.coalesce("label", "node").alias("label"))
        grouped = saved(pairs.join(groups, "key", "left"))
        fresh = self.shared.groupBy("pattern").agg(F.sum("size").alias("fresh"))
        # A source's own text is a pattern of its own.
        joint = grouped.where("label is not null").join(fresh, "pattern", "left").select(
            "label", "edge", F.coalesce("pattern", "edge").alias("pattern"), "key", "held", "quota",
            F.coalesce("fresh", "held").alias("fresh"))
        alone = grouped.where("label is null").select(
            "edge", F.least(max_repeats * F.col("held"), F.col("quota")).alias("amount"))
        solved = joint.groupBy("label").applyInPandas(flows(max_repeats), "edge bigint, amount bigint")
        return alone.unionByName(solved)

    def small(self, table: DataFrame) -> DataFrame:
        """A table of at most one row per pair, marked for a broadcast if there are few."""
        return F.broadcast(table) if self.few else table

    def readings(self, docs: DataFrame, name: str) -> DataFrame:
        """The documents with how often each is read, 0 to ``max_repeats``, as column ``name`` (replaced if there)."""
        marks = {key: unused(docs, f"__mix_{key}") for key in (*self.own, "pattern", "edge")}
        rows = docs.select("*", *[column.alias(marks[key]) for key, column in self.own.items()])
        shared = self.shared.select(
            F.col("t1").alias("__mix_s1"), F.col("t2").alias("__mix_s2"), F.col("pattern").alias(marks["pattern"]))
        rows = rows.join(
            F.broadcast(shared) if self.shared.count() <= FEW_DECISIONS else shared,
            (F.col(marks["t1"]) == F.col("__mix_s1")) & (F.col(marks["t2"]) == F.col("__mix_s2")), "left")
        rows = rows.withColumn(marks["edge"], F.xxhash64(F.coalesce(marks["pattern"], F.lit(0)), marks["key"]))
        decided = {c: f"__mix_d_{c}" for c in self.decisions.columns}
        of = {c: F.col(new) for c, new in decided.items()}
        own = {key: F.col(marks[key]) for key in self.own}
        size = own["size"]
        turn = turn_of(own, of)
        bucket = bucket_of(own["rank"], turn, of)
        upto = F.struct(F.coalesce(turn, F.lit(0)), own["rank"], own["id"], size) <= F.struct(
            *[of[f"cut_{c}"] for c in ORDER])
        chosen = (bucket < of["last"]) | ((bucket == of["last"]) & of["cut_rank"].isNotNull() & upto)
        times = F.coalesce(of["whole"], F.lit(0)) + F.coalesce(chosen, F.lit(False)).cast("bigint")
        return (
            rows.join(self.small(self.decisions.withColumnsRenamed(decided)), F.col(marks["edge"]) == of["edge"], "left")
            .select(*[F.col(f"`{c}`") for c in docs.columns if c != name],
                    F.when(size > 0, times).otherwise(0).cast("int").alias(name)))


# What puts documents of a pair in order.
ORDER = ("turn", "rank", "id", "size")


def turn_of(row: Mapping[str, Column], plan: Mapping[str, Column]) -> Column:
    """Place of a shared text on its pattern's circle, seen from where its source starts; else null.

    Copies within a source are dealt to rounds, and a round goes once around.
    """
    around = F.pmod(F.pmod(row["t1"], F.lit(CIRCLE)) - plan["offset"], F.lit(CIRCLE))
    turn = F.pmod(F.xxhash64(F.lit(3), row["rank"]), plan["copies"])
    return F.floor((turn * CIRCLE + around) / plan["copies"])


def bucket_of(rank: Column, turn: Column, plan: Mapping[str, Column]) -> Column:
    """Bucket of a document: its part of the circle, or from the first eight digits of its rank."""
    dealt = F.conv(F.substring(rank, 1, 8), 16, 10).cast("bigint") % plan["buckets"]
    return F.when(turn.isNotNull(), F.floor(turn * plan["buckets"] / CIRCLE)).otherwise(dealt)


def cuts(rows: DataFrame, plan: DataFrame, small: Callable[[DataFrame], DataFrame]) -> DataFrame:
    """The plan with the bucket and the document of each pair where its rest ends."""
    # The plan has a row per pattern and source; so have at most the tables below.
    joined = rows.where("size > 0").join(small(plan.where("rest > 0")), "edge")
    columns = {name: F.col(name) for name in joined.columns}
    turn = turn_of(columns, columns)
    planned = joined.withColumns({
        "bucket": bucket_of(F.col("rank"), turn, columns), "turn": F.coalesce(turn, F.lit(0))})
    sums = planned.groupBy("edge", "bucket", "rest").agg(F.sum("size").alias("bucket_size"))
    earlier = Window.partitionBy("edge").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    # What stands before the bucket where the rest ends is smaller than the rest.
    ends = (
        sums.withColumn("before", F.coalesce(F.sum("bucket_size").over(earlier), F.lit(0)))
        .where("before < rest and rest <= before + bucket_size")
        .select("edge", F.col("bucket").alias("last"), F.col("before").alias("ahead"),
                (F.col("rest") - F.col("before")).alias("open")))
    inside = planned.join(small(ends), "edge").where("bucket = last")
    upto = Window.partitionBy("edge").orderBy(*ORDER).rowsBetween(Window.unboundedPreceding, -1)
    # A document belongs to the rest if at least half of it does.
    cut = (
        inside.withColumn("before", F.coalesce(F.sum("size").over(upto), F.lit(0)))
        .where(F.col("before") + F.col("size") / 2 <= F.col("open"))
        .groupBy("edge").agg(F.max(F.struct(*ORDER, "before")).alias("cut")))
    inside_cut = F.coalesce(F.col("cut.before") + F.col("cut.size"), F.lit(0))
    return (
        plan.join(small(ends.select("edge", "last", "ahead")), "edge", "left")
        .join(small(cut), "edge", "left")
        .select("edge", "whole", "buckets", "offset", "copies", "last",
                *[F.col(f"cut.{c}").alias(f"cut_{c}") for c in ORDER],
                (F.col("whole") * F.col("held") + F.coalesce("ahead", F.lit(0)) + inside_cut).alias("got")))
