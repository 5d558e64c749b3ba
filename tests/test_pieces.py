"""Operators give the same rows whether or not a key is split into pieces.

The data holds one symbol with more than a third of all rows, trades of equal
time and a null symbol, and the row limit is set low enough to split both.
"""

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from quotemill.operators import bars, joins, ranking, reports, series
from quotemill.operators.pieces import PIECE, cut, hot_keys, lookup

START = dt.datetime(2024, 1, 1)
HOT = 40


@pytest.fixture(scope="module")
def trades(spark):
    rng = random.Random(7)
    symbols = ["HOT"] * 400 + [None] * 150 + [f"S{i}" for i in range(30)] * 8
    rng.shuffle(symbols)
    rows = []
    for i, symbol in enumerate(symbols):
        minute = rng.randrange(60) * 3 if i % 3 else 0
        rows.append((f"{i:05d}", symbol, START + dt.timedelta(minutes=minute),
                     round(rng.uniform(0, 9), 1), rng.randrange(50)))
    return spark.createDataFrame(
        rows, "id string, symbol string, datetime timestamp, last_price double, volume int").cache()


@pytest.fixture(scope="module")
def hourless_bars(trades):
    """One bar per symbol and minute, more than the limit for the hot symbol."""
    return bars.ohlcv(trades, "1 minute").withColumn("adj_close", F.col("close")).cache()


@pytest.fixture(scope="module")
def paid_bars(hourless_bars):
    minute = F.unix_seconds("datetime") / 60
    return hourless_bars.withColumns({
        "stock_splits": F.when(minute % 45 == 0, 2.0).otherwise(0.0),
        "dividends": F.when(minute % 33 == 0, 0.25).otherwise(0.0),
    }).cache()


def content(df):
    rows = df.select(*[
        F.round(f.name, 9).alias(f.name) if f.dataType.typeName() == "double" else F.col(f.name)
        for f in df.schema
    ])
    return sorted(map(repr, rows.select(*sorted(rows.columns)).collect()))


def both(make):
    whole, split = make(10**9), make(HOT)
    assert sorted(whole.columns) == sorted(split.columns)
    first = content(whole)
    assert first and first == content(split)


def test_hot_keys_are_found(trades):
    assert hot_keys(trades, ["symbol"], 10**9) is None
    hot = hot_keys(trades, ["symbol"], HOT).collect()
    assert {(r.symbol, r["_rows"]) for r in hot} == {("HOT", 400), (None, 150)}


def test_pieces_stay_small_and_ordered(trades):
    pieces = cut(trades, ["symbol"], ["datetime", "id"], hot_rows=HOT)
    spans = (
        pieces.hot.groupBy("symbol", PIECE)
        .agg(F.count("*").alias("n"), F.min(F.struct("datetime", "id")).alias("a"),
             F.max(F.struct("datetime", "id")).alias("b"))
        .orderBy("symbol", PIECE).collect()
    )
    assert len(spans) > 10 and max(r.n for r in spans) < 150
    for one, two in zip(spans, spans[1:]):
        assert one.symbol != two.symbol or one.b < two.a


def test_positions(trades):
    both(lambda hot: cut(trades, ["symbol"], ["datetime", "id"], hot_rows=hot)
         .positions("place").rows().drop(PIECE))


def test_returns(trades):
    both(lambda hot: series.returns(trades, "symbol", price="last_price", ties=["id"], hot_rows=hot))


@pytest.mark.parametrize("rows", [1, 2, 7, 100])
def test_moving(trades, rows):
    both(lambda hot: series.moving(
        trades, "symbol", rows, price="last_price", ties=["id"], hot_rows=hot))


def test_running(trades):
    both(lambda hot: series.running(trades, ["symbol"], hot_rows=hot))


def test_running_by_day(trades):
    days = trades.withColumn("day", F.to_date("datetime"))
    both(lambda hot: series.running(days, ["symbol", "day"], hot_rows=hot))


def test_sessions(trades):
    both(lambda hot: bars.sessions(trades, 60, hot_rows=hot))


def test_adjust(paid_bars):
    both(lambda hot: series.adjust(paid_bars, "symbol", hot_rows=hot))


def test_gaps_and_fill(hourless_bars):
    both(lambda hot: series.gaps(hourless_bars, "symbol", 60, hot_rows=hot))
    both(lambda hot: series.fill(hourless_bars, "symbol", 60, hot_rows=hot))


def test_ranks(trades):
    both(lambda hot: ranking.ranks(trades, "symbol", "last_price", ["id"], hot_rows=hot))


def test_as_of(trades, hourless_bars):
    some = hourless_bars.where(F.minute("datetime") % 9 == 0)
    both(lambda hot: joins.as_of(trades, some, values=["open", "close"], hot_rows=hot))


def test_to_bar(trades, hourless_bars):
    some = hourless_bars.where(F.minute("datetime") % 9 != 0)
    both(lambda hot: joins.to_bar(trades, some, "1 minute"))


@pytest.mark.parametrize("how", ["left", "inner", "left_semi", "left_anti"])
def test_lookup(spark, trades, how):
    table = spark.createDataFrame([("HOT", 1), ("S1", 2), ("zz", 3), (None, 4)], "symbol string, x int")
    both(lambda hot: lookup(trades, table, ["symbol"], how))


def test_percentiles(trades):
    both(lambda hot: reports.percentiles(trades, "symbol", "last_price", (1, 50, 99, 100), hot_rows=hot))


def test_zscores(trades):
    both(lambda hot: reports.zscores(trades, "symbol", "last_price"))


def test_valuation(spark, trades):
    orders = trades.select(F.col("id").alias("order_id"), (F.col("volume") % 5).alias("holder"))
    fills = trades.select(F.col("id").alias("order_id"), "symbol", F.col("volume").alias("quantity"))
    quotes = spark.createDataFrame([("HOT", 1.5), ("S1", 2.0)], "symbol string, price double")

    def value(hot):
        return joins.valuation(joins.positions(orders, fills), quotes)

    both(value)
    assert all(r.unquoted > 0 for r in value(HOT).collect())


def test_null_is_a_group_of_its_own(trades):
    nulls = trades.where("symbol IS NULL")
    for hot in (10**9, HOT):
        ranked = ranking.ranks(trades, "symbol", "last_price", ["id"], hot_rows=hot)
        assert ranked.where("symbol IS NULL").count() == nulls.count()
        middle = reports.percentiles(trades, "symbol", "last_price", (50,), hot_rows=hot)
        expected = sorted(r.last_price for r in nulls.collect())[nulls.count() // 2 - 1]
        assert middle.where("symbol IS NULL").first().p50 == expected
