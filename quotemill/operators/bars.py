"""Price bars, window statistics, sessions and averages.

All of these aggregate before they shuffle, so a busy symbol or a busy minute
costs no more than the others after the map side.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quotemill.operators.pieces import HOT_ROWS, cut


def known(amount: Column | str) -> Column:
    """The amount, or null where it is not a number."""
    column = F.col(amount) if isinstance(amount, str) else amount
    return F.when(~F.isnan(column), column)


def bar_values(ties: Sequence[str] = ("id",)) -> list[Column]:
    """What a bar holds of its trades, as aggregates."""
    price = known("last_price")
    place = F.when(price.isNotNull(), F.struct("datetime", *ties))
    return [
        F.min_by(price, place).alias("open"),
        F.max(price).alias("high"),
        F.min(price).alias("low"),
        F.max_by(price, place).alias("close"),
        F.sum(F.col("volume").cast("bigint")).alias("volume"),
        F.count(F.lit(1)).alias("trades"),
    ]


def ohlcv(
    trades: DataFrame,
    width: str,
    *,
    ties: Sequence[str] = ("id",),
) -> DataFrame:
    """Open, high, low, close and volume per symbol and window, batch or streaming.

    Windows include their start and exclude their end. Trades of equal time
    are ordered by ``ties``. Trades without a price count, but set none.
    """
    return (
        trades.groupBy("symbol", F.window("datetime", width).alias("bar"))
        .agg(*bar_values(ties))
        .select("symbol", F.col("bar.start").alias("datetime"),
                "open", "high", "low", "close", "volume", "trades")
    )


def sliding_stats(trades: DataFrame, width_seconds: int, slide_seconds: int) -> DataFrame:
    """Statistics per symbol over overlapping windows.

    Trades are reduced to panes of one slide first; only panes are copied into
    the windows that cover them. The average is over the trades with a price.
    """
    price = known("last_price")
    if width_seconds % slide_seconds:
        raise ValueError("the width must be a multiple of the slide")
    panes = trades.groupBy("symbol", F.window("datetime", f"{slide_seconds} seconds").alias("pane")).agg(
        F.count(F.lit(1)).alias("n"),
        F.count(price).alias("priced"),
        F.sum(price).alias("total"),
        F.min(price).alias("low"),
        F.max(price).alias("high"),
        F.sum(F.col("volume").cast("bigint")).alias("volume"),
    )
    starts = F.array(*[
        F.col("pane.start") - F.make_dt_interval(secs=F.lit(back))
        for back in range(0, width_seconds, slide_seconds)
    ])
    return (
        panes.withColumn("window_start", F.explode(starts))
        .groupBy("symbol", "window_start")
        .agg(
            F.sum("n").alias("trades"),
            (F.sum("total") / F.nullif(F.sum("priced"), F.lit(0))).alias("avg_price"),
            F.min("low").alias("low"),
            F.max("high").alias("high"),
            F.sum("volume").alias("volume"),
        )
        .withColumn("window_end", F.col("window_start") + F.make_dt_interval(secs=F.lit(width_seconds)))
    )


def sessions(trades: DataFrame, gap_seconds: int, *, hot_rows: int | None = HOT_ROWS) -> DataFrame:
    """Bursts of trades per symbol with no pause longer than the gap.

    A trade exactly one gap after the last still belongs to the session.
    Trades in one slot of the gap's length are always in one session, so they
    are merged into a slot first and only slots are ordered.
    """
    gap = gap_seconds * 1_000_000
    moment = F.unix_micros("datetime")
    slots = (
        trades.groupBy("symbol", (moment - F.pmod(moment, F.lit(gap))).alias("_slot"))
        .agg(
            F.min("datetime").alias("_first"),
            F.max("datetime").alias("_last"),
            F.count(F.lit(1)).alias("trades"),
            F.sum(F.col("volume").cast("bigint")).alias("volume"),
        )
    )
    pieces = cut(slots, ["symbol"], ["_slot"], hot_rows=hot_rows)
    pieces = pieces.carry(_before=(pieces.last_of(F.col("_last")), "last"))
    previous = F.coalesce(F.lag("_last").over(pieces.window), F.col("_before"))
    pause = F.unix_micros("_first") - F.unix_micros(previous)
    pieces = pieces.transform(
        lambda rows: rows.withColumn("_opens", F.when(pause.isNull() | (pause > gap), F.col("_first"))))
    opened = F.col("_opens").isNotNull()
    pieces = pieces.carry(_running=(pieces.last_of(F.col("_opens"), when=opened), "last"))
    start = F.coalesce(F.last("_opens", ignorenulls=True).over(pieces.window), F.col("_running"))
    return (
        pieces.rows().withColumn("session_start", start)
        .groupBy("symbol", "session_start")
        .agg(
            (F.max("_last") + F.make_dt_interval(secs=F.lit(gap_seconds))).alias("session_end"),
            F.sum("trades").alias("trades"),
            F.sum("volume").alias("volume"),
        )
    )


def resample(bars: DataFrame, width: str) -> DataFrame:
    """Wider bars from narrow ones: first open, last close, summed volume."""
    return (
        bars.groupBy("symbol", F.window("datetime", width).alias("bar"))
        .agg(
            F.min_by("open", "datetime").alias("open"),
            F.max("high").alias("high"),
            F.min("low").alias("low"),
            F.max_by("close", "datetime").alias("close"),
            F.sum("volume").alias("volume"),
        )
        .select("symbol", F.col("bar.start").alias("datetime"), "open", "high", "low", "close", "volume")
    )


def vwap(trades: DataFrame, *by: Column | str) -> DataFrame:
    """Volume-weighted average price; null where nothing was traded at a price.

    Price and volume are those of the trades that have both.
    """
    priced = known(F.col("last_price").cast("double"))
    amount = known(F.col("volume").cast("double"))
    notional = F.sum(priced * amount)
    volume = F.sum(F.when(priced.isNotNull(), amount))
    return trades.groupBy(*by).agg(
        (notional / F.nullif(volume, F.lit(0.0))).alias("vwap"),
        volume.alias("volume"),
        F.count(F.lit(1)).alias("trades"),
    )
