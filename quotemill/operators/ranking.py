"""Rankings, top movers and latest quotes."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from quotemill.operators.pieces import HOT_ROWS, PIECE, cut, hot_keys, lookup


# Ranks below this are cut off before the shuffle (spark.sql.optimizer.windowGroupLimitThreshold).
SMALL_K = 1_000


def movers(bars: DataFrame) -> DataFrame:
    """Change from open to close; bars without a positive open are left out."""
    return bars.where(F.col("open") > 0).withColumn("change", F.col("close") / F.col("open") - 1)


def top(rows: DataFrame, k: int, score: str, ties: Sequence[str]) -> DataFrame:
    """The k rows with the highest score; ``ties`` decide between equals."""
    return rows.orderBy(F.col(score).desc(), *ties).limit(k)


def top_per_group(
    rows: DataFrame, k: int, group: str, score: str, ties: Sequence[str], *, hot_rows: int = HOT_ROWS,
) -> DataFrame:
    """The k highest rows of each group.

    The rank filter is applied before the shuffle too, so a large group sends
    at most k rows per input task. Spark does so for small k only; for others
    the rows of large groups are numbered piece by piece.
    """
    if k >= SMALL_K:
        # Pieces order all columns alike, ties ascending. Descending scores start
        # with not-a-number and end with null.
        value = F.col(score)
        down = {
            "_null": value.isNull().cast("int"), "_number": (~F.isnan(value.cast("double"))).cast("int"),
            "_down": -value}
        numbered = cut(rows.withColumns(down), [group], [*down, *ties], hot_rows=hot_rows).positions("place")
        return numbered.rows().where(F.col("place") <= k).drop(PIECE, *down)
    window = Window.partitionBy(group).orderBy(F.col(score).desc(), *ties)
    return rows.withColumn("place", F.row_number().over(window)).where(F.col("place") <= k)


def ranks(
    rows: DataFrame, group: str, score: str, ties: Sequence[str], *,
    hot_rows: int = HOT_ROWS, probe: DataFrame | None = None,
) -> DataFrame:
    """Rank, dense rank and row number by descending score in each group.

    Rows with the same score share both ranks; ``ties`` order the row numbers
    and should make a row unique in its group. ``probe`` is as in ``cut``.
    """
    order = Window.partitionBy(group).orderBy(F.col(score).desc())
    if hot_keys(rows if probe is None else probe, [group], hot_rows) is None:
        return (
            rows.withColumn("rank", F.rank().over(order).cast("bigint"))
            .withColumn("dense_rank", F.dense_rank().over(order).cast("bigint"))
            .withColumn("row_number", F.row_number().over(
                Window.partitionBy(group).orderBy(F.col(score).desc(), *[F.col(t).desc() for t in ties])
            ).cast("bigint"))
        )
    scores = rows.groupBy(group, score).agg(F.count(F.lit(1)).alias("_n"))
    pieces = cut(scores, [group], [score], descending=True, hot_rows=hot_rows).positions("dense_rank")
    pieces = pieces.carry(_ahead=(F.sum("_n"), "sum"))
    ahead = F.sum("_n").over(pieces.window.rowsBetween(Window.unboundedPreceding, -1))
    scores = pieces.rows().withColumn(
        "rank", 1 + F.coalesce(ahead, F.lit(0)) + F.coalesce("_ahead", F.lit(0))
    ).select(group, score, "rank", "dense_rank")
    numbered = cut(rows, [group], [score, *ties], descending=True, hot_rows=hot_rows)
    numbered = numbered.positions("row_number").rows().drop(PIECE)
    return lookup(numbered, scores, [group, score], "inner", null_safe=True)


def latest(rows: DataFrame, key: str, *, order: Sequence[str] = ("datetime", "id")) -> DataFrame:
    """The last row per key.

    The last value of the first order column is found first, by a hash
    aggregation of two columns; one row per key comes out, which the optimizer
    broadcasts if it measures it as small. Only the rows at that value are put
    in order to decide between equals.
    """
    columns = [c for c in rows.columns if c != key]
    newest = rows.groupBy(key).agg(F.max(order[0]).alias("_newest")).withColumnRenamed(key, "_key").alias("n")
    at = F.col(f"r.{key}").eqNullSafe(F.col("n._key")) & F.col(f"r.{order[0]}").eqNullSafe(F.col("n._newest"))
    return (
        rows.alias("r").join(newest, at, "left_semi")
        .groupBy(key)
        .agg(F.max_by(F.struct(*columns), F.struct(*order)).alias("_last"))
        .select(key, "_last.*")
    )
