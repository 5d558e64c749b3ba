"""Summaries over stored trades and bars."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quotemill.operators.bars import known
from quotemill.operators.pieces import HOT_ROWS, cut, lookup


def condition_breakdown(trades: DataFrame) -> DataFrame:
    """Trades and volume per trade condition.

    A trade with several conditions counts under each. Trades with an empty or
    absent list are counted under the null condition.
    """
    return (
        trades.select("volume", F.explode_outer("trade_conditions").alias("condition"))
        .groupBy("condition")
        .agg(F.count(F.lit(1)).alias("trades"), F.sum(F.col("volume").cast("bigint")).alias("volume"))
    )


def with_condition(trades: DataFrame, condition: str, *, least: int = 1) -> DataFrame:
    """Trades that carry a condition, among at least ``least`` conditions."""
    return trades.where(
        F.array_contains("trade_conditions", condition) & (F.size("trade_conditions") >= least))


def rollup_report(trades: DataFrame) -> DataFrame:
    """Trades, volume and notional per symbol and day, per symbol, and overall.

    ``level`` is 0, 1 and 3 for these, which tells a total from a null symbol.
    Days are summed first, and only day rows are repeated for the totals.
    """
    days = trades.groupBy("symbol", F.to_date("datetime").alias("day")).agg(
        F.count(F.lit(1)).alias("n"),
        F.sum(F.col("volume").cast("bigint")).alias("v"),
        F.sum(known(F.col("last_price") * F.col("volume").cast("double"))).alias("m"),
    )
    return days.rollup("symbol", "day").agg(
        F.grouping_id().cast("int").alias("level"),
        F.sum("n").alias("trades"),
        F.sum("v").alias("volume"),
        F.sum("m").alias("notional"),
    )


def distinct_symbols(trades: DataFrame) -> DataFrame:
    """Number of different symbols per day."""
    return trades.groupBy(F.to_date("datetime").alias("day")).agg(
        F.count_distinct("symbol").alias("symbols"))


def approx_distinct_symbols(trades: DataFrame, rsd: float = 0.02) -> DataFrame:
    """Estimated number of different symbols per day, in constant memory per day."""
    return trades.groupBy(F.to_date("datetime").alias("day")).agg(
        F.approx_count_distinct("symbol", rsd).alias("symbols"))


def trade_checks() -> list[Column]:
    """Counts of trades that miss or break a rule, as aggregates."""
    return [
        F.count(F.lit(1)).alias("rows"),
        F.count_if(F.col("symbol").isNull() | (F.col("symbol") == "")).alias("no_symbol"),
        F.count_if(F.col("datetime").isNull()).alias("no_time"),
        F.count_if(~F.coalesce(F.col("last_price") > 0, F.lit(False))).alias("no_positive_price"),
        F.count_if(~F.coalesce(F.col("volume") > 0, F.lit(False))).alias("no_positive_volume"),
    ]


def bar_checks(symbol: str = "symbol") -> list[Column]:
    """Counts of bars that miss or break a rule, as aggregates."""
    inside = F.col("open").between(F.col("low"), F.col("high")) & F.col("close").between(
        F.col("low"), F.col("high"))
    return [
        F.count(F.lit(1)).alias("rows"),
        F.count_if(F.col(symbol).isNull() | F.col("datetime").isNull()).alias("no_key"),
        F.count_if(~F.coalesce(F.col("high") >= F.col("low"), F.lit(False))).alias("high_below_low"),
        F.count_if(~F.coalesce(inside, F.lit(False))).alias("outside_range"),
        F.count_if(~F.coalesce(F.col("volume") > 0, F.lit(False))).alias("no_positive_volume"),
    ]


def checks(row: T.StructType) -> list[Column]:
    """The checks of a stored table, told from its columns."""
    return trade_checks() if "last_price" in row.names else bar_checks("ticker")


def trade_quality(trades: DataFrame) -> DataFrame:
    """Counts of trades that miss or break a rule, in one pass."""
    return trades.agg(*trade_checks())


def bar_quality(bars: DataFrame) -> DataFrame:
    """Counts of bars that miss or break a rule, in one pass."""
    return bars.agg(*bar_checks())


def approx_percentiles(
    rows: DataFrame, key: str, value: str, percents: Sequence[int], accuracy: int = 10_000,
) -> DataFrame:
    """Approximate percentiles per key from a sketch of bounded size."""
    return rows.groupBy(key).agg(
        F.percentile_approx(value, [p / 100 for p in percents], accuracy).alias("_q")
    ).select(key, *[F.col("_q")[i].alias(f"p{p}") for i, p in enumerate(percents)])


def percentiles(
    rows: DataFrame, key: str, value: str, percents: Sequence[int], *, hot_rows: int = HOT_ROWS,
) -> DataFrame:
    """Exact percentiles per key: the smallest value that covers the share of rows.

    Equal values are counted together, then the counts are added up in value
    order, so no key's values are ever held in one buffer. Nulls are left out.
    """
    valued = rows.where(F.col(value).isNotNull())
    counted = valued.groupBy(key, value).agg(F.count(F.lit(1)).alias("_n"))
    pieces = cut(counted, [key], [value], hot_rows=hot_rows, probe=valued)
    pieces = pieces.carry(_below=(F.sum("_n"), "sum"))
    running = F.sum("_n").over(pieces.window.rowsBetween(Window.unboundedPreceding, 0))
    covered = pieces.rows().select(
        F.col(key), F.col(value), (running + F.coalesce("_below", F.lit(0))).alias("_covered"))
    totals = valued.groupBy(key).agg(F.count(F.lit(1)).alias("_total"))
    joined = lookup(covered, totals, [key], "inner", null_safe=True)
    return joined.groupBy(key).agg(*[
        F.min(F.when(F.col("_covered") * 100 >= F.col("_total") * p, F.col(value))).alias(f"p{p}")
        for p in percents
    ])


def zscores(rows: DataFrame, key: str, value: str) -> DataFrame:
    """Distance of each value from its key's mean, in sample deviations.

    Null where the deviation is zero or unknown. Mean and deviation are partial
    aggregates joined back; the group itself is never gathered.
    """
    stats = rows.groupBy(key).agg(
        F.avg(known(value)).alias("_mean"),
        F.stddev_samp(known(value)).alias("_dev"),
    )
    return (
        lookup(rows, stats, [key], null_safe=True)
        .withColumn("zscore", (F.col(value) - F.col("_mean")) / F.nullif(F.col("_dev"), F.lit(0.0)))
        .drop("_mean", "_dev")
    )


def outliers(rows: DataFrame, key: str, value: str, limit: float = 3.0) -> DataFrame:
    return zscores(rows, key, value).where(F.abs("zscore") > limit)
