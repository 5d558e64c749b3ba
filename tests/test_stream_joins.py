"""Joins and chained windows of running streams against the same work on the whole input."""

import datetime as dt
import random
from collections import Counter

import pytest
from pyspark.sql import functions as F

from quotemill.operators import bars, joins
from quotemill.streaming import joins as stream_joins
from quotemill.streaming import sinks, windows
from quotemill.streaming.jobs import run

START = dt.datetime(2024, 1, 1)
TRADE = "id string, symbol string, datetime timestamp, last_price double, volume int"
BAR = "symbol string, datetime timestamp, open double, high double, low double, close double, volume bigint"
YEAR = dt.timedelta(days=365)


@pytest.fixture(autouse=True)
def few_state_stores(spark):
    """A store per operator and partition is opened in every micro-batch."""
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", "2")
    yield
    spark.conf.set("spark.sql.shuffle.partitions", before)


def made(spark, seed, trades=600, hours=48):
    draw = random.Random(seed)
    symbols = ["A", "A", "A", "B", "C", None]
    times = sorted(START + dt.timedelta(seconds=draw.randrange(hours * 3600)) for _ in range(trades))
    rows = [(f"t{k}", draw.choice(symbols), time, draw.choice([None, float("nan"), draw.random()]), draw.choice([None, 1, 5]))
            for k, time in enumerate(times)]
    quotes = [(symbol, START + dt.timedelta(hours=hour), 1.0 + hour, 9.0, 0.5, float(hour), hour)
              for hour in range(hours) for symbol in ("A", "B", "D", None) if draw.random() < 0.6]
    return rows, quotes


def delivered(spark, rows, schema, path, order, column):
    """A stream of files of a fifth of the time each, in an order, then one row far ahead."""
    hours = 48 * 3600 / len(set(order))
    for number in order:
        part = [r for r in rows if r[column] is not None and int((r[column] - START).total_seconds() // hours) == number]
        part += [r for r in rows if r[column] is None] if number == order[0] else []
        spark.createDataFrame(part, schema).coalesce(1).write.mode("append").parquet(path)
    last = tuple(START + YEAR if k == column else v for k, v in enumerate(rows[-1]))
    spark.createDataFrame([last], schema).coalesce(1).write.mode("append").parquet(path)
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(path)


def written(spark, rows, folder):
    sink = sinks.BatchDirectory(str(folder / "out"))
    query = windows.start(rows, sink, str(folder / "cp"), mode="append")
    run(query)
    return sink.read(spark, rows.schema).drop("query_id"), query


def plain(df):
    return Counter(map(repr, df.select(*sorted(c for c in df.columns if c != "batch_id")).collect()))


IN_ORDER, MIXED = (0, 1, 2, 3, 4), (3, 0, 4, 1, 2)


@pytest.mark.parametrize("order, bar_order, lateness", [
    (IN_ORDER, IN_ORDER, "1 hour"), (MIXED, IN_ORDER, "3 days"), (MIXED, MIXED, "3 days")])
def test_as_of_stream_equals_batch(spark, tmp_path, order, bar_order, lateness):
    rows, quotes = made(spark, 1)
    # Trades at a bar's very start, before any bar, and without a time.
    rows += [("s1", "A", quotes[0][1], 1.0, 1), ("s2", "A", START, 1.0, 1), ("s3", "B", None, 1.0, 1)]
    rows.sort(key=lambda r: (r[2] is not None, r[2] or START))
    trades = delivered(spark, rows, TRADE, str(tmp_path / "trades"), order, 2)
    stream = delivered(spark, quotes, BAR, str(tmp_path / "bars"), bar_order, 1)
    with stream_joins.keyed_state(spark):
        joined = stream_joins.as_of(trades, stream, lateness, values=("close", "volume"), slot="10 minutes", salts=4)
        found, query = written(spark, joined, tmp_path)
    expected = joins.as_of(
        spark.createDataFrame(rows, TRADE), spark.createDataFrame(quotes, BAR), values=("close", "volume"))
    assert plain(found) == plain(expected)
    if lateness == "1 hour":
        assert found.select("batch_id").distinct().count() > 3


def test_as_of_state_holds_the_bound_and_one_bar(spark, tmp_path):
    """After the closing rows a key keeps its last bar and the closing slot, not the history."""
    rows, quotes = made(spark, 2, trades=3000)
    trades = delivered(spark, rows, TRADE, str(tmp_path / "trades"), IN_ORDER, 2)
    stream = delivered(spark, quotes, BAR, str(tmp_path / "bars"), IN_ORDER, 1)
    with stream_joins.keyed_state(spark):
        joined = stream_joins.as_of(trades, stream, "1 hour", slot="10 minutes", salts=1)
        _, query = written(spark, joined, tmp_path)
    state = [p.stateOperators[0].numRowsTotal for p in query.recentProgress if p.stateOperators]
    keys = len({r[1] for r in rows} | {q[0] for q in quotes})
    # A carried bar a key, and a slot and its timers for the closing trade and bar.
    assert state[-1] <= keys + 8 < max(state)


def test_ladder_equals_batch_at_every_width(spark, tmp_path):
    rows, _ = made(spark, 3)
    trades = delivered(spark, rows, TRADE, str(tmp_path / "trades"), IN_ORDER, 2)
    widths = ("1 minute", "5 minutes", "1 hour")
    found, _ = written(spark, windows.rungs(trades, widths, "30 minutes"), tmp_path)
    whole = spark.createDataFrame(rows, TRADE)
    for width in widths:
        mine = found.where(F.col("width") == width).drop("width")
        assert plain(mine) == plain(bars.ohlcv(whole, width)), width
    assert found.select("batch_id").distinct().count() > 3


def test_ladder_writes_each_bar_once_the_watermark_has_passed(spark, tmp_path):
    """Without a closing row, the bars are those that ended before the bound."""
    rows, _ = made(spark, 4)
    path = str(tmp_path / "trades")
    for start in range(0, len(rows), 200):
        spark.createDataFrame(rows[start:start + 200], TRADE).coalesce(1).write.mode("append").parquet(path)
    stream = spark.readStream.schema(TRADE).option("maxFilesPerTrigger", 1).parquet(path)
    found, _ = written(spark, windows.rungs(stream, ("5 minutes", "1 hour"), "30 minutes"), tmp_path)
    bound = rows[-1][2] - dt.timedelta(minutes=30)
    whole = spark.createDataFrame(rows, TRADE)
    narrow = bars.ohlcv(whole, "5 minutes").where(F.col("datetime") + F.expr("INTERVAL 5 MINUTES") <= F.lit(bound))
    assert plain(found.where("width = '5 minutes'").drop("width")) == plain(narrow)


@pytest.mark.parametrize("order, lateness", [(IN_ORDER, "1 hour"), (MIXED, "3 days")])
def test_reconcile_stream_equals_batch(spark, tmp_path, order, lateness):
    rows, quotes = made(spark, 5)
    # A provided bar off the grid pairs with none.
    quotes += [("A", START + dt.timedelta(hours=3, minutes=30), 1.0, 2.0, 0.5, 1.0, 3)]
    quotes.sort(key=lambda q: q[1])
    trades = delivered(spark, rows, TRADE, str(tmp_path / "trades"), order, 2)
    stream = delivered(spark, quotes, BAR, str(tmp_path / "bars"), order, 1)
    found, query = written(spark, stream_joins.reconcile(trades, stream, "1 hour", lateness), tmp_path)
    expected = joins.reconcile(bars.ohlcv(spark.createDataFrame(rows, TRADE), "1 hour"), spark.createDataFrame(quotes, BAR))
    assert plain(found) == plain(expected)
    missing = Counter(r.missing for r in found.collect())
    assert missing["ours"] and missing["theirs"] and missing[None]
    last = [p for p in query.recentProgress if p.stateOperators][-1]
    # Only the closing rows are left in state.
    assert sum(op.numRowsTotal for op in last.stateOperators) <= 4


def test_empty_streams(spark, tmp_path):
    for name, schema in (("trades", TRADE), ("bars", BAR)):
        spark.createDataFrame([], schema).write.parquet(str(tmp_path / name))
    trades, stream = (spark.readStream.schema(schema).parquet(str(tmp_path / name))
                      for name, schema in (("trades", TRADE), ("bars", BAR)))
    with stream_joins.keyed_state(spark):
        found, _ = written(spark, stream_joins.as_of(trades, stream, "1 hour"), tmp_path / "a")
    assert found.columns == ["id", "symbol", "datetime", "last_price", "volume", "bar_datetime", "bar_close", "batch_id"]
    assert found.isEmpty()
    found, _ = written(spark, stream_joins.reconcile(trades, stream, "1 hour", "1 hour"), tmp_path / "b")
    assert found.isEmpty()
