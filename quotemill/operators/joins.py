"""Trades against bars, positions against quotes, and symbol sets."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quotemill.operators.pieces import HOT_ROWS, cut, lookup
from quotemill.session import shared_dir

# Blocks of bars that are broadcast, some 20 MB; more are joined by shuffle.
FEW_BLOCKS = 200_000


def as_of(
    trades: DataFrame, bars: DataFrame, *, values: Sequence[str] = ("close",), tie: str = "id",
    hot_rows: int = HOT_ROWS, probe: DataFrame | None = None,
) -> DataFrame:
    """Each trade with the last bar at or before its time; null if there is none.

    Both sides are put in one ordered sequence per symbol and the bar values
    are carried forward, so no trade is ever paired with more than one bar.
    ``probe`` is as in ``cut``: the trades alone where bars are few beside them.
    """
    boxed = F.struct(F.col("datetime").alias("bar_datetime"), *[F.col(v).alias(f"bar_{v}") for v in values])
    # The key is named anew on both sides: a union of two tables laid out by it keeps
    # that layout only if the key is the projection's own.
    symbol = F.col("symbol").alias("symbol")
    quoted = bars.select(symbol, "datetime", F.lit(0).alias("_side"), boxed.alias("_bar"))
    traded = trades.select(*[symbol if c == "symbol" else F.col(c) for c in trades.columns], F.lit(1).alias("_side"))
    mixed = traded.unionByName(quoted, allowMissingColumns=True)
    pieces = cut(mixed, ["symbol"], ["datetime", "_side", tie], hot_rows=hot_rows, probe=probe)
    has_bar = F.col("_bar").isNotNull()
    pieces = pieces.carry(_earlier=(pieces.last_of(F.col("_bar"), when=has_bar), "last"))
    found = F.coalesce(F.last("_bar", ignorenulls=True).over(pieces.window), F.col("_earlier"))
    return (
        pieces.rows().withColumn("_found", found)
        .where(F.col("_side") == 1)
        .select(*trades.columns, "_found.*")
    )


def to_bar(
    trades: DataFrame, bars: DataFrame, width: str, *, values: Sequence[str] = ("open", "close"),
) -> DataFrame:
    """Each trade with the bars whose interval contains it; trades without one are left out.

    A bar lasts ``width`` from its start, wherever that is. Time is cut into
    buckets of the width; a bar stands in the one or two it touches and a trade
    in its own, so the join is an equality with a range test on top.
    """
    placed = trades.withColumn("_bucket", bucket("datetime", width)).alias("t")
    table = touched(bars, width, values).alias("b")
    inside = (
        (F.col("t.symbol") == F.col("b.symbol")) & (F.col("t._bucket") == F.col("b._bucket"))
        & (F.col("t.datetime") >= F.col("b.bar_start"))
        & (F.col("t.datetime") < F.col("b.bar_start") + F.expr(f"INTERVAL {width}")))
    return placed.join(table, inside).select(
        *[f"t.{c}" for c in trades.columns], "b.bar_start", *[f"b.bar_{v}" for v in values])


def bucket(time: str, width: str) -> Column:
    """Start of the bucket of ``width`` that holds a time."""
    return F.window(time, width)["start"]


def touched(bars: DataFrame, width: str, values: Sequence[str]) -> DataFrame:
    """Bars with each bucket they touch: the one of their start, and the next if they reach into it."""
    first = bars.withColumn("_first", bucket("datetime", width))
    step = F.expr(f"INTERVAL {width}")
    both = F.when(F.col("_first") == F.col("datetime"), F.array("_first")).otherwise(
        F.array(F.col("_first"), F.col("_first") + step))
    return first.select(
        "symbol", F.col("datetime").alias("bar_start"), *[F.col(v).alias(f"bar_{v}") for v in values],
        F.explode(both).alias("_bucket"))


def width_of(level: Column) -> Column:
    """Units in a block of a level."""
    return F.call_function("shiftleft", F.lit(1).cast("bigint"), level)


def cover(first: Column, end: Column, top: int) -> Column:
    """Aligned blocks of 2^level units that make up ``[first, end)``, at most two a level up to ``top``.

    A level gives its first block if that is odd and its last if it is even,
    counted among those that fit; pairs of others are a block of the next level.
    """
    def blocks(level: Column) -> Column:
        size = width_of(level)
        low, high = -F.floor(-first / size), F.floor(end / size)
        some = low < high
        return F.array(
            F.when(some & (F.pmod(low, F.lit(2)) == 1), F.struct(level.alias("level"), low.alias("block"))),
            F.when(some & (F.pmod(high, F.lit(2)) == 1), F.struct(level.alias("level"), (high - 1).alias("block"))))

    found = F.flatten(F.transform(F.sequence(F.lit(0), F.lit(top)), blocks))
    return F.filter(found, lambda block: block.isNotNull())


def to_any_bar(
    trades: DataFrame, bars: DataFrame, unit: str, *, end: str = "bar_end", values: Sequence[str] = ("open", "close"),
) -> DataFrame:
    """Each trade with all bars ``[datetime, end)`` that contain it, whatever their lengths.

    Time is cut into blocks of 1, 2, 4, ... units. A bar stands once for each
    block of its cover, about twice the logarithm of its length, and a trade
    once for each level that any bar uses, so the join is an equality, and with
    bars on the unit's grid every match is a result. Ends off the grid are
    rounded outwards and tested. Bars without a start, an end or a length
    contain nothing.
    """
    step = F.expr(f"unix_micros(timestamp_seconds(0) + INTERVAL {unit})")
    start, stop = F.unix_micros("datetime"), F.unix_micros(end)
    table = bars.where(F.col("datetime") < F.col(end)).select(
        "symbol", F.col("datetime").alias("bar_start"), F.col(end).alias("bar_end"),
        *[F.col(v).alias(f"bar_{v}") for v in values],
        F.floor(start / step).alias("_first"), (-F.floor(-stop / step)).alias("_end"))
    # Read three times below, and built of many trades.
    shared_dir(bars.sparkSession)
    table = table.checkpoint()
    longest = table.agg(F.max(F.col("_end") - F.col("_first"))).first()[0] or 1
    top = int(longest).bit_length()
    covered = table.withColumn("_cover", F.explode(cover(F.col("_first"), F.col("_end"), top))).select(
        "*", "_cover.level", "_cover.block").drop("_cover", "_first", "_end")
    # At most one row per level, some forty.
    counts = {row["level"]: row["count"] for row in covered.groupBy("level").count().collect()}
    levels = sorted(counts)
    placed = trades.withColumn("level", F.explode(F.array(*[F.lit(k) for k in levels]).cast("array<int>"))).withColumn(
        "block", F.floor(F.floor(F.unix_micros("datetime") / step) / width_of(F.col("level"))))
    inside = (
        (F.col("t.symbol") == F.col("b.symbol")) & (F.col("t.level") == F.col("b.level"))
        & (F.col("t.block") == F.col("b.block"))
        & (F.col("t.datetime") >= F.col("b.bar_start")) & (F.col("t.datetime") < F.col("b.bar_end")))
    # The optimizer takes both sides for as small as before they were repeated, so the
    # method is told: bars go out while they are few by count, trades never do.
    method = "broadcast" if sum(counts.values()) <= FEW_BLOCKS else "merge"
    return placed.alias("t").join(covered.alias("b").hint(method), inside).select(
        *[f"t.{c}" for c in trades.columns], "b.bar_start", "b.bar_end", *[f"b.bar_{v}" for v in values])


def reconcile(
    ours: DataFrame, theirs: DataFrame, *,
    values: Sequence[str] = ("open", "high", "low", "close", "volume"),
) -> DataFrame:
    """Bars of two sources side by side, with differences and the missing side.

    Both sides hold one bar per symbol and start. Keys compare null-safe.
    """
    same = F.col("o.symbol").eqNullSafe(F.col("t.symbol")) & F.col("o.datetime").eqNullSafe(
        F.col("t.datetime"))
    left = ours.withColumn("_ours", F.lit(True)).alias("o")
    right = theirs.withColumn("_theirs", F.lit(True)).alias("t")
    return left.join(right, same, "full_outer").select(
        F.coalesce("o.symbol", "t.symbol").alias("symbol"),
        F.coalesce("o.datetime", "t.datetime").alias("datetime"),
        F.when(F.col("_theirs").isNull(), "theirs").when(F.col("_ours").isNull(), "ours").alias("missing"),
        *[(F.col(f"o.{v}") - F.col(f"t.{v}")).alias(f"{v}_diff") for v in values],
    )


def positions(orders: DataFrame, fills: DataFrame) -> DataFrame:
    """Quantity per holder and symbol from fills of orders."""
    owned = lookup(
        fills.select("order_id", "symbol", "quantity"), orders.select("order_id", "holder"),
        ["order_id"], "inner")
    return owned.groupBy("holder", "symbol").agg(F.sum(F.col("quantity").cast("double")).alias("quantity"))


def valuation(positions: DataFrame, quotes: DataFrame) -> DataFrame:
    """Value per holder at the latest quote; positions without one are counted."""
    priced = lookup(positions, quotes.select("symbol", "price"), ["symbol"])
    return priced.groupBy("holder").agg(
        F.count(F.lit(1)).alias("positions"),
        F.count_if(F.col("price").isNull()).alias("unquoted"),
        F.sum(F.col("quantity") * F.col("price")).alias("value"),
    )


def never_traded(universe: DataFrame, trades: DataFrame) -> DataFrame:
    """Symbols of the universe without a trade."""
    return universe.select("symbol").distinct().join(
        trades.select("symbol").distinct(), "symbol", "left_anti")


def traded(universe: DataFrame, trades: DataFrame) -> DataFrame:
    """Symbols of the universe with a trade."""
    return universe.select("symbol").distinct().join(
        trades.select("symbol").distinct(), "symbol", "left_semi")


def in_both(left: DataFrame, right: DataFrame) -> DataFrame:
    """Symbols that occur in both feeds, each once."""
    return left.select("symbol").distinct().intersect(right.select("symbol").distinct())


def surplus(left: DataFrame, right: DataFrame) -> DataFrame:
    """Rows of the left side left over after removing one per equal right row."""
    return left.exceptAll(right)
