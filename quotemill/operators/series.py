"""Bar and trade series in time order per key."""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quotemill.operators.bars import known
from quotemill.operators.pieces import HOT_ROWS, PIECE, Pieces, cut


# Steps of a gap that are written out from one array.
FILL_RUN = 10_000


def returns(
    bars: DataFrame, key: str, *, price: str = "adj_close", time: str = "datetime",
    ties: Sequence[str] = (), hot_rows: int | None = HOT_ROWS,
) -> DataFrame:
    """Simple and log return against the previous bar.

    Null in a key's first bar and where the previous price is not positive;
    the log return is also null where the price is not positive.
    """
    pieces = cut(bars, [key], [time, *ties], hot_rows=hot_rows)
    boxed = F.struct(F.col(price).alias("price"))
    pieces = pieces.carry(_before=(pieces.last_of(boxed), "last"))
    previous = F.coalesce(F.lag(boxed).over(pieces.window), F.col("_before"))["price"]
    ratio = F.when(F.col("_previous") > 0, F.col(price) / F.col("_previous"))
    return (
        pieces.rows().withColumn("_previous", previous)
        .withColumn("simple_return", ratio - 1)
        .withColumn("log_return", F.when(ratio > 0, F.ln(ratio)))
        .drop(PIECE, "_before", "_previous")
    )


def moving(
    bars: DataFrame, key: str, rows: int, *, price: str = "close", time: str = "datetime",
    ties: Sequence[str] = (), hot_rows: int | None = HOT_ROWS,
) -> DataFrame:
    """Average and sample deviation of the last ``rows`` bars, this one included.

    A key's first bars use the shorter history; the deviation of one bar is null.
    """
    frame, window = cut(bars, [key], [time, *ties], hot_rows=hot_rows).with_lookback(rows - 1)
    last = window.rowsBetween(-rows + 1, 0)
    return (
        frame.withColumn("moving_avg", F.avg(known(price)).over(last))
        .withColumn("volatility", F.stddev_samp(known(price)).over(last))
        .where("_own")
        .drop(PIECE, "_own")
    )


# A block of an exponential average, in time constants: long enough that nothing
# from before the last block counts in double precision (e^-200), short enough
# that weights within a block neither overflow nor vanish.
BLOCK_DECAY = 200.0

# Rows of one key that a single task takes through an exponential average. Its
# windows feed one another, so a task holds every row several times.
NESTED_ROWS = 1_000_000


def _recurrence(
    pieces: Pieces, value: str, first: Column | None, alpha: float, name: str,
) -> Pieces:
    """Adds ``s`` with ``s = (1 - alpha) s + alpha value`` along each key, from ``first`` or 0.

    Every step is an affine map of the last state. Rows are numbered where they
    have a value; blocks of them are summed with growing weights, a block starts
    from the end of the one before, and a piece from the composed maps of the
    pieces before it. Rows without a value repeat the state.
    """
    keep = 1.0 - alpha
    block = max(1, math.ceil(BLOCK_DECAY / -math.log(keep))) if keep > 0 else 1
    so_far = pieces.window.rowsBetween(Window.unboundedPreceding, 0)
    before = pieces.window.rowsBetween(Window.unboundedPreceding, -1)
    inside = Window.partitionBy(*pieces.keys, PIECE, "_block").orderBy(*pieces.sorting).rowsBetween(
        Window.unboundedPreceding, 0)
    counted = F.col(value).isNotNull()
    place = F.pmod(F.col("_number") - 1, F.lit(block))
    weight = F.pow(F.lit(keep), F.lit(1.0) * F.col("_place")) if keep > 0 else F.lit(1.0)

    def local(rows: DataFrame) -> DataFrame:
        """The state with nothing before the block, and the end of the block before."""
        numbered = (
            rows.withColumn("_number", F.count(value).over(so_far))
            .withColumns({"_block": F.greatest(F.lit(0), F.floor((F.col("_number") - 1) / block)), "_place": place}))
        summed = numbered.withColumn(
            "_own", alpha * weight * F.coalesce(F.sum(F.when(counted, F.col(value) / weight)).over(inside), F.lit(0.0)))
        ends = F.when(counted & (F.col("_place") == block - 1), F.col("_own"))
        started = summed.withColumn("_start", F.last(ends, ignorenulls=True).over(before))
        # The state if the piece started from nothing.
        return started.withColumn(
            "_alone", F.col("_own") + keep * weight * F.coalesce("_start", F.lit(0.0)))

    pieces = pieces.transform(local)
    whole = F.struct(
        F.pow(F.lit(keep), F.count(value)).alias("a"),
        F.coalesce(pieces.last_of(F.col("_alone"), when=counted), F.lit(0.0)).alias("b"))
    pieces = pieces.carry(_map=(whole, "affine"))
    begin = F.lit(0.0) if first is None else first
    entered = F.coalesce(F.col("_map")["a"] * begin + F.col("_map")["b"], begin)
    # What came in has decayed once per value of the piece so far.
    decayed = F.pow(F.lit(keep), F.lit(1.0) * F.col("_number")) * entered
    state = F.when(F.col("_number") == 0, F.when(F.col("_map").isNotNull(), entered)).otherwise(F.col("_alone") + decayed)
    return pieces.transform(lambda rows: rows.withColumn(name, state).drop(
        "_number", "_block", "_place", "_own", "_start", "_alone", "_map"))


def exponential(
    bars: DataFrame, key: str, alpha: float, *, price: str = "close", time: str = "datetime",
    ties: Sequence[str] = (), hot_rows: int | None = NESTED_ROWS,
) -> DataFrame:
    """Exponential average of the price and volatility around it.

    The average starts at a key's first price and moves ``alpha`` of the way to
    each price. The variance weighs squared distances from the average before
    the price the same way, from 0; ``volatility`` is its root. Bars without a
    price repeat both; before the first price they are null.
    """
    if not 0 < alpha <= 1:
        raise ValueError("alpha is above 0 and at most 1")
    pieces = cut(bars, [key], [time, *ties], hot_rows=hot_rows)
    pieces = pieces.transform(lambda rows: rows.withColumn("_price", known(F.col(price).cast("double"))))
    priced = F.col("_price").isNotNull()
    opening = F.min_by("_price", F.when(priced, F.struct(time, *ties)))
    so_far = pieces.window.rowsBetween(Window.unboundedPreceding, 0)
    pieces = pieces.carry(_opened=(opening, "first")).transform(lambda rows: rows.withColumn(
        "_first", F.coalesce("_opened", F.first("_price", ignorenulls=True).over(so_far))))
    pieces = _recurrence(pieces, "_price", F.col("_first"), alpha, "average")
    # The average before each price; of the first one, itself.
    pieces = pieces.carry(_average=(pieces.last_of(F.col("average"), when=priced), "last"))
    before = F.coalesce(
        F.last("average", ignorenulls=True).over(pieces.window.rowsBetween(Window.unboundedPreceding, -1)), F.col("_average"))
    pieces = pieces.transform(lambda rows: rows.withColumn("_before", before).withColumn(
        "_gap", F.when(priced, F.pow(F.coalesce(F.col("_price") - F.col("_before"), F.lit(0.0)), F.lit(2.0)))))
    pieces = _recurrence(pieces, "_gap", None, alpha, "_spread")
    variance = F.when(F.col("average").isNotNull(), (1.0 - alpha) * F.coalesce("_spread", F.lit(0.0)))
    return pieces.rows().withColumn("volatility", F.sqrt(variance)).drop(
        PIECE, "_price", "_opened", "_first", "_average", "_before", "_gap", "_spread")


def running(
    trades: DataFrame, keys: Sequence[str], *, price: str = "last_price", volume: str = "volume",
    order: Sequence[str] = ("datetime", "id"), hot_rows: int | None = HOT_ROWS,
) -> DataFrame:
    """Cumulative volume, running high and drawdown from it, starting over per key."""
    pieces = cut(trades, list(keys), list(order), hot_rows=hot_rows)
    amount = F.col(volume).cast("bigint")
    pieces = pieces.carry(_sum=(F.sum(amount), "sum"), _high=(F.max(price), "max"))
    so_far = pieces.window.rowsBetween(Window.unboundedPreceding, 0)
    high = F.greatest(F.max(price).over(so_far), F.col("_high"))
    total = F.sum(amount).over(so_far)
    return (
        pieces.rows()
        .withColumn("cumulative_volume", F.coalesce(total + F.col("_sum"), total, F.col("_sum")))
        .withColumn("running_high", high)
        .withColumn("drawdown", F.col(price) / F.nullif(F.col("running_high"), F.lit(0.0)) - 1)
        .drop(PIECE, "_sum", "_high")
    )


def adjust(
    bars: DataFrame, key: str, *, close: str = "close", time: str = "datetime",
    ties: Sequence[str] = (), hot_rows: int | None = HOT_ROWS,
) -> DataFrame:
    """Closes adjusted for later splits and dividends, and the total return.

    A split of 0 means none. The adjustment of a bar is the product, over all
    later bars, of 1 / split and of 1 - dividend / close of the bar before the
    payment. ``total_return`` is the holder's gain since the previous bar,
    with split shares and dividends counted in.
    """
    before = cut(bars, [key], [time, *ties], hot_rows=hot_rows)
    boxed = F.struct(F.col(close).alias("close"))
    before = before.carry(_edge=(before.last_of(boxed), "last"))
    previous = F.coalesce(F.lag(boxed).over(before.window), F.col("_edge"))["close"]
    held = F.when(F.col("_previous") > 0, F.col("_previous"))
    split = F.when(F.col("stock_splits") > 0, F.col("stock_splits")).otherwise(1.0)
    dividend = F.coalesce("dividends", F.lit(0.0))
    paid = F.coalesce(dividend / held, F.lit(0.0))
    kept = F.when((paid > 0) & (paid < 1), 1 - paid).otherwise(1.0)
    with_factors = (
        before.rows().withColumn("_previous", previous)
        .withColumn("_factor", kept / split)
        .withColumn("total_return", (F.col(close) * split + dividend) / held - 1)
        .drop(PIECE, "_edge", "_previous")
    )
    after = cut(with_factors, [key], [time, *ties], descending=True, hot_rows=hot_rows)
    after = after.carry(_later=(F.product("_factor"), "product"))
    later = after.window.rowsBetween(Window.unboundedPreceding, -1)
    return (
        after.rows()
        .withColumn("adjustment", F.coalesce(F.product("_factor").over(later), F.lit(1.0))
                    * F.coalesce("_later", F.lit(1.0)))
        .withColumn("adjusted_close", F.col(close) * F.col("adjustment"))
        .drop(PIECE, "_factor", "_later")
    )


def gaps(
    bars: DataFrame, key: str, step_seconds: int, *, time: str = "datetime",
    hot_rows: int | None = HOT_ROWS,
) -> DataFrame:
    """Stretches of missing bars between a key's first and last bar."""
    step = F.make_dt_interval(secs=F.lit(step_seconds))
    missing = F.unix_seconds("_next") - F.unix_seconds(time) - step_seconds
    return (
        _with_next(bars, key, time, hot_rows)
        .where(missing > 0)
        .select(
            key,
            (F.col(time) + step).alias("gap_start"),
            F.col("_next").alias("gap_end"),
            F.floor(missing / step_seconds).cast("bigint").alias("missing_bars"),
        )
    )


def fill(
    bars: DataFrame, key: str, step_seconds: int, *, close: str = "close", volume: str = "volume",
    time: str = "datetime", hot_rows: int | None = HOT_ROWS,
) -> DataFrame:
    """One bar per step between a key's first and last bar.

    A missing bar repeats the last close with no volume and ``filled`` true.
    Every bar writes out the steps up to the next one, so the calendar is
    never built apart from the data nor joined to it. Steps are written out in
    runs of ``FILL_RUN``, so no gap has to fit in one array.
    """
    last = F.greatest(F.lit(0), F.ceil(
        (F.unix_seconds("_next") - F.unix_seconds(time)) / step_seconds).cast("bigint") - 1)
    runs = F.sequence(F.lit(0).cast("bigint"), F.coalesce(last, F.lit(0)), F.lit(FILL_RUN).cast("bigint"))
    steps = F.sequence("_run", F.least(F.col("_run") + (FILL_RUN - 1), F.coalesce("_last", F.lit(0))))
    at = F.timestamp_micros(F.unix_micros(time) + F.col("_step") * (step_seconds * 1_000_000))
    return (
        _with_next(bars, key, time, hot_rows)
        .withColumns({"_last": last, "_run": F.explode(runs)})
        .withColumn("_step", F.explode(steps))
        .withColumn("_at", at)
        .select(
            key,
            F.col("_at").alias(time),
            F.col(close),
            F.when(F.col("_at") == F.col(time), F.col(volume)).otherwise(0).alias(volume),
            (F.col("_at") != F.col(time)).alias("filled"),
        )
    )


def _with_next(bars: DataFrame, key: str, time: str, hot_rows: int | None) -> DataFrame:
    pieces = cut(bars, [key], [time], descending=True, hot_rows=hot_rows)
    pieces = pieces.carry(_edge=(pieces.last_of(F.col(time)), "last"))
    following = F.coalesce(F.lag(time).over(pieces.window), F.col("_edge"))
    return pieces.rows().withColumn("_next", following).drop(PIECE, "_edge")
