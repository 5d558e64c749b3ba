"""Merkle manifest of a table: leaves, subroots per tree, one root, and proofs.

A leaf is the digest of a row's fields. The leaves of a tree (a source) stand in
the order of a column; every ``FAN`` consecutive nodes become one node of the
next level until one is left, the subroot. Subroots, in the order of their
trees, become the root the same way.

Each level is one window: lag and lead columns of fixed offsets 1 to ``FAN - 1``,
masked by a node's slot and its run's length, are the siblings on its left and
right, and the first child of a run hashes them into the parent. Going down
again, a node's path is its own siblings and then its parent's path.

A tree may hold most of the table, so no task sees a whole tree. Rows are range
partitioned by tree and order, numbered within pieces, and moved on by the rows
of the pieces ahead, of which there are as many as partitions. Windows span
``SPAN`` nodes going up and one run going down. Node tables are written to the
shared folder, so a lost executor repeats tasks, not levels.

A null field is digested as null, a null tree is a tree of its own and comes
first, a null order value comes first in its tree. Rows of equal order stand in
the order of their leaves; equal rows get proofs for neighbouring places. An
empty table gives no rows. Other columns of the table, of any name, stay out.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quotemill.llm.common import saved

FIELDS = ("doc_id", "source", "lang", "n_chars", "text")
FAN = 16
# Nodes of one window going up; a multiple of FAN.
SPAN = FAN * FAN
# Rows a piece of the range partitioning holds at most, about.
PIECE_ROWS = 2_000_000


def digest(*parts: Column) -> Column:
    """Lowercase hex SHA-256 of the parts' concatenated text."""
    return F.sha2(F.concat(*parts), 256)


def written(value: Column) -> Column:
    """A field as it is digested: its byte count, a colon and its text, or ``-``."""
    text = value.cast("string")
    return F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-"))


def leaf(fields: Sequence[str], changed: Mapping[str, Column] | None = None) -> Column:
    """Digest of a row's fields, some of them replaced."""
    other = changed or {}
    return digest(*[written(other.get(name, F.col(f"`{name}`"))) for name in fields])


def placed(nodes: DataFrame, tree: str, order: Sequence[str]) -> DataFrame:
    """The nodes with ``pos``, the place in their tree from 0, and ``size``, its number of nodes.

    The order should be unique. Range bounds are sampled anew by every plan, so
    the pieces are saved before their rows are counted.
    """
    partitions = int(nodes.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    pieces = max(partitions, -(-nodes.count() // PIECE_ROWS))
    ranged = saved(
        nodes.repartitionByRange(pieces, tree, *order).withColumn("piece", F.spark_partition_id()))
    whole = Window.partitionBy(tree)
    ahead = (
        ranged.groupBy(tree, "piece").agg(F.count(F.lit(1)).alias("rows"))
        .select(
            tree, "piece", F.sum("rows").over(whole).alias("size"),
            (F.sum("rows").over(whole.orderBy("piece")) - F.col("rows")).alias("ahead")))
    place = F.row_number().over(Window.partitionBy(tree, "piece").orderBy(*order))
    return (
        ranged.withColumn("place", place).join(ahead, [tree, "piece"])
        .withColumn("pos", F.col("ahead") + F.col("place") - 1)
        .drop("piece", "place", "ahead"))


def with_siblings(nodes: DataFrame, span: int) -> DataFrame:
    """The nodes with ``run``, ``slot`` and the hashes left and right of them in their run."""
    numbered = nodes.withColumns({
        "run": F.expr(f"pos div {FAN}"), "slot": F.col("pos") % FAN, "part": F.expr(f"pos div {span}")})
    # One run is the whole part then, so the run's own name keeps the partitioning for a join.
    part = Window.partitionBy("tree", "run" if span == FAN else "part").orderBy("pos")
    length = F.least(F.lit(FAN), F.col("size") - F.col("run") * FAN)
    none = F.lit("")
    offsets = range(1, FAN)
    lags = [F.when(F.col("slot") >= k, F.lag("hash", k).over(part)).otherwise(none) for k in offsets]
    leads = [F.when(F.col("slot") + k < length, F.lead("hash", k).over(part)).otherwise(none) for k in offsets]
    return numbered.withColumns({"left": F.concat(*reversed(lags)), "right": F.concat(*leads)}).drop("part")


def parents(nodes: DataFrame) -> DataFrame:
    """The next level: first children hash their runs. A tree's only node stays as it is."""
    hashed = F.when(F.col("size") > 1, digest(F.col("hash"), F.col("right"))).otherwise(F.col("hash"))
    return with_siblings(nodes, SPAN).where("slot = 0").select(
        "tree", F.col("run").alias("pos"), F.expr(f"(size + {FAN - 1}) div {FAN}").alias("size"),
        hashed.alias("hash"))


def levels(nodes: DataFrame) -> list[DataFrame]:
    """Node tables from the leaves up to the one where every tree is one node."""
    largest = nodes.agg(F.max("size")).first()[0] or 1
    out = [nodes]
    while largest > 1:
        out.append(saved(parents(out[-1].select("tree", "pos", "size", "hash"))))
        largest = -(-largest // FAN)
    return out


def descended(tables: list[DataFrame], top: DataFrame, keep: Sequence[str]) -> DataFrame:
    """The lowest table's rows with their paths, given the path above each tree's last node.

    ``keep`` names columns of ``top`` that every node inherits.
    """
    found = tables[-1].join(top, "tree")
    for nodes in reversed(tables[:-1]):
        above = found.select("tree", F.col("pos").alias("run"), *keep, "path")
        own = F.array(F.struct("left", "right"))
        found = (
            with_siblings(nodes, FAN).join(above, ["tree", "run"])
            .withColumn("path", F.when(F.col("size") > 1, F.concat(own, "path")).otherwise(F.col("path")))
            .drop("run", "slot", "left", "right"))
    return found


def folded(start: Column, path: Column) -> Column:
    """The root that follows from a leaf and the siblings on its way up."""
    return F.aggregate(path, start, lambda node, step: digest(step["left"], node, step["right"]))


def proof(path: Column) -> Column:
    """All siblings of a path, level by level, left to right."""
    return F.array_join(F.transform(path, lambda step: F.concat(step["left"], step["right"])), "")


def manifest(
    docs: DataFrame, fields: Sequence[str] = FIELDS, *, tree_col: str = "source", order_col: str = "doc_id",
    seen: Mapping[str, Column] | None = None, when: Column | None = None,
) -> DataFrame:
    """Leaf, roots, path and verification of every row.

    ``seen`` gives fields as they were received, in rows where ``when`` holds;
    the root that follows from the received leaf shows whether they differ.
    Columns: the order column, ``leaf``, ``subroot``, ``root``, ``path`` (structs
    of the hashes left and right, from the leaf's level up), ``folded_root`` and
    ``verified``.
    """
    own = leaf(fields)
    received = F.when(when, leaf(fields, seen)).otherwise(F.lit(None)) if when is not None else F.lit(None)
    tree = F.col(f"`{tree_col}`").cast("string")
    rows = saved(docs.select(
        # A key without nulls that sorts as the names do, the missing one first.
        F.coalesce(F.concat(F.lit("1"), tree), F.lit("0")).alias("tree"),
        F.col(f"`{order_col}`").alias("id"), own.alias("hash"),
        received.cast("string").alias("received"), F.monotonically_increasing_id().alias("tie")))
    leaves = saved(placed(rows, "tree", ["id", "hash", "tie"]).drop("tie"))
    tables = levels(leaves)
    # Every tree's last node is a leaf of the tree above all.
    last = tables[-1].select(F.lit(0).alias("above"), F.col("tree").alias("name"), "hash")
    roots = levels(saved(placed(last, "above", ["name"])).withColumnRenamed("above", "tree"))
    top = roots[-1].select("tree", F.col("hash").alias("root"), F.array().cast("array<struct<left:string,right:string>>").alias("path"))
    per_tree = descended(roots, top, ["root"]).select(
        F.col("name").alias("tree"), F.col("hash").alias("subroot"), "root", "path")
    found = descended(tables, per_tree, ["subroot", "root"])
    again = folded(F.coalesce("received", "hash"), F.col("path"))
    return found.select(
        F.col("id").alias(order_col), F.col("hash").alias("leaf"), "subroot", "root", "path",
        again.alias("folded_root")).withColumn("verified", F.col("folded_root") == F.col("root"))
