"""Lots in first-in-first-out order: which buy a sale closes, and what stays open.

Units are counted along each key's buys and, apart from that, along its sales. The
n-th unit bought is matched with the n-th unit sold, whichever came first, so
sales beyond the holding open short lots that later buys close. A fill is then
an interval of units, and matching is the overlap of two rows of intervals: all
starts in one order, each with the buy and the sale that are current there.
Nothing is paired that does not overlap, and there are at most as many matches
as fills. Keys of any size are cut as other series are.

Quantities are counted in millionths, as whole numbers, so intervals meet
exactly. Fills without a positive quantity or a side are left out; a price may
be missing and then its gain is.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quotemill.operators.pieces import HOT_ROWS, cut, hot_keys, lookup

SCALE = 1_000_000


@dataclass(frozen=True)
class Intervals:
    """Fills as intervals of units: side (true for buys), start and end, and the fill itself."""

    rows: DataFrame
    # As for ``cut``: None where no key has more fills than one task may sort. Rows are then laid out by key.
    hot_rows: int | None


def counted(
    fills: DataFrame, keys: Sequence[str], bought: Column, *, order: Sequence[str] = ("datetime", "id"),
    quantity: str = "volume", price: str = "last_price", hot_rows: int | None = HOT_ROWS,
) -> Intervals:
    """Fills with the place of their units among their key's buys or sales.

    Keys are counted once, for this and for all that follows. Where none is
    large, rows are shuffled once, by key, and every later step works inside that layout.
    """
    keys = list(keys)
    if hot_rows is not None and hot_keys(fills.select(*keys), keys, hot_rows) is None:
        hot_rows = None
    units = F.round(F.col(quantity).cast("double") * SCALE).cast("bigint")
    sided = fills.select(
        *keys, *[F.col(c).alias(f"_o{n}") for n, c in enumerate(order)], bought.alias("_buy"),
        units.alias("_units"), F.struct(*order, F.col(price).cast("double").alias("price")).alias("_fill")
    ).where("_units > 0 and _buy is not null")
    sided = sided if hot_rows is not None else sided.repartition(*keys)
    pieces = cut(sided, [*keys, "_buy"], [f"_o{n}" for n in range(len(order))], hot_rows=hot_rows)
    pieces = pieces.carry(_ahead=(F.sum("_units"), "sum"))
    end = F.coalesce("_ahead", F.lit(0)) + F.sum("_units").over(
        pieces.window.rowsBetween(Window.unboundedPreceding, 0))
    return Intervals(pieces.rows().withColumn("_end", end).select(
        *keys, "_buy", (F.col("_end") - F.col("_units")).alias("_start"), "_end", "_fill"), hot_rows)


def fifo(
    fills: DataFrame, keys: Sequence[str], bought: Column, *, order: Sequence[str] = ("datetime", "id"),
    quantity: str = "volume", price: str = "last_price", hot_rows: int | None = HOT_ROWS,
    intervals: Intervals | None = None,
) -> DataFrame:
    """Matched lots: one row per overlap of a buy and a sale, with quantity and gain.

    ``bought`` tells the side of a fill and ``order`` is unique within a key.
    ``buy_`` and ``sale_`` columns hold the order columns and the price.
    ``intervals`` are those of ``counted`` with the same arguments, where they are at hand.
    """
    keys = list(keys)
    intervals = intervals or counted(
        fills, keys, bought, order=order, quantity=quantity, price=price, hot_rows=hot_rows)
    boxed = F.struct("_end", "_fill")
    sides = {"_bought": F.when(F.col("_buy"), boxed), "_sold": F.when(~F.col("_buy"), boxed)}
    pieces = cut(intervals.rows.withColumns(sides), keys, ["_start", "_buy"], hot_rows=intervals.hot_rows)
    pieces = pieces.carry(**{
        f"{name}_before": (pieces.last_of(F.col(name), when=F.col(name).isNotNull()), "last") for name in sides})
    so_far = pieces.window.rowsBetween(Window.unboundedPreceding, 0)
    current = {name: F.coalesce(F.last(name, ignorenulls=True).over(so_far), F.col(f"{name}_before")) for name in sides}
    met = pieces.rows().withColumns(current)
    units = F.least("_bought._end", "_sold._end") - F.col("_start")
    matched = met.where(F.col("_bought").isNotNull() & F.col("_sold").isNotNull() & (units > 0)).withColumn("_units", units)
    gain = F.col("_units") / SCALE * (F.col("_sold._fill.price") - F.col("_bought._fill.price"))
    return matched.select(
        *keys,
        *[F.col(f"_bought._fill.{c}").alias(f"buy_{c}") for c in (*order, "price")],
        *[F.col(f"_sold._fill.{c}").alias(f"sale_{c}") for c in (*order, "price")],
        (F.col("_units") / SCALE).alias("quantity"), gain.alias("gain"))


def open_lots(
    fills: DataFrame, keys: Sequence[str], bought: Column, *, order: Sequence[str] = ("datetime", "id"),
    quantity: str = "volume", price: str = "last_price", hot_rows: int | None = HOT_ROWS,
    intervals: Intervals | None = None,
) -> DataFrame:
    """What is left of each fill after all matches; sold short lots have a negative quantity.

    ``intervals`` are as in ``fifo``.
    """
    keys = list(keys)
    intervals = intervals or counted(
        fills, keys, bought, order=order, quantity=quantity, price=price, hot_rows=hot_rows)
    totals = {
        name: F.max(F.when(F.col("_buy") == side, F.col("_end")))
        for name, side in (("_total_sold", False), ("_total_bought", True))}
    if intervals.hot_rows is None:
        whole = Window.partitionBy(*keys)
        both = intervals.rows.withColumns({name: total.over(whole) for name, total in totals.items()})
    else:
        ends = intervals.rows.groupBy(*keys).agg(*[total.alias(name) for name, total in totals.items()])
        both = lookup(intervals.rows, ends, keys, "inner", null_safe=True)
    other = F.coalesce(F.when(F.col("_buy"), F.col("_total_sold")).otherwise(F.col("_total_bought")), F.lit(0))
    left = F.col("_end") - F.greatest("_start", other)
    sign = F.when(F.col("_buy"), 1.0).otherwise(-1.0)
    return both.where(left > 0).select(
        *keys, *[F.col(f"_fill.{c}") for c in (*order, "price")], (sign * left / SCALE).alias("quantity"))


def gains(matched: DataFrame, left: DataFrame, quotes: DataFrame, keys: Sequence[str], symbol: str = "symbol") -> DataFrame:
    """Per key: quantity closed and its gain, quantity left, its cost, and its gain at the quote.

    ``quotes`` has ``price`` for each symbol; lots without one have no open gain.
    """
    keys = list(keys)
    nothing = F.lit(None).cast("double")
    closed = matched.select(
        *keys, F.col("quantity").alias("closed"), F.col("gain").alias("realised"),
        *[nothing.alias(c) for c in ("open", "cost", "open_gain")])
    quoted = lookup(left.withColumnRenamed("price", "paid"), quotes.select(F.col("symbol").alias(symbol), "price"), [symbol])
    opened = quoted.select(
        *keys, nothing.alias("closed"), nothing.alias("realised"), F.col("quantity").alias("open"),
        (F.col("quantity") * F.col("paid")).alias("cost"),
        (F.col("quantity") * (F.col("price") - F.col("paid"))).alias("open_gain"))
    return closed.unionByName(opened).groupBy(*keys).agg(
        *[F.sum(c).alias(c) for c in ("closed", "realised", "open", "cost", "open_gain")])
