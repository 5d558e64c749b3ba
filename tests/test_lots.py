"""Lots against a queue, exponential averages against the loop, bars of any length against all pairs."""

import datetime as dt
import inspect
import math
import random
from collections import Counter, deque

import pytest
from pyspark.sql import functions as F

from quotemill.operators import joins, lots, series

START = dt.datetime(2024, 1, 1)
FILLS = "id string, holder string, symbol string, datetime timestamp, last_price double, volume double, side string"


def fills(seed, rows=300, hot=0.6):
    draw = random.Random(seed)
    out = []
    for k in range(rows):
        holder = "big" if draw.random() < hot else draw.choice(["h1", "h2", None])
        out.append((f"f{k:04d}", holder, draw.choice(["A", "B"]), START + dt.timedelta(minutes=draw.randrange(400)),
                    draw.choice([None, draw.randrange(1, 50) / 2]), draw.choice([0.0, -1.0, None, 1.0, 2.5, 7.0, 0.000001]),
                    draw.choice(["buy", "sell", "sell", None])))
    return out


def by_queue(rows):
    """Matches and remainders of each key, fill by fill."""
    matched, left = Counter(), Counter()
    keys = {(r[1], r[2]) for r in rows}
    for key in keys:
        queues = {"buy": deque(), "sell": deque()}
        own = sorted((r for r in rows if (r[1], r[2]) == key and r[6] and r[5] and r[5] > 0), key=lambda r: (r[3], r[0]))
        for fill in own:
            units, other = round(fill[5] * 1_000_000), queues["sell" if fill[6] == "buy" else "buy"]
            while units and other:
                first, rest = other[0]
                take = min(units, rest)
                buy, sale = (fill, first) if fill[6] == "buy" else (first, fill)
                matched[*key, buy[0], sale[0], take] += 1
                units -= take
                if rest == take:
                    other.popleft()
                else:
                    other[0] = (first, rest - take)
            if units:
                queues[fill[6]].append((fill, units))
        for side, queue in queues.items():
            for fill, rest in queue:
                left[*key, fill[0], rest if side == "buy" else -rest] += 1
    return matched, left


@pytest.mark.parametrize("hot_rows", [None, 40, 7])
def test_lots_equal_a_queue(spark, hot_rows):
    rows = fills(1)
    df = spark.createDataFrame(rows, FILLS)
    bought = F.when(F.col("side") == "buy", True).when(F.col("side") == "sell", False)
    keys = ["holder", "symbol"]
    matched, left = by_queue(rows)
    found = lots.fifo(df, keys, bought, hot_rows=hot_rows).collect()
    assert Counter((r.holder, r.symbol, r.buy_id, r.sale_id, round(r.quantity * 1e6)) for r in found) == matched
    prices = {r[0]: r[4] for r in rows}
    for r in found:
        one, two = prices[r.buy_id], prices[r.sale_id]
        assert (r.gain is None) if one is None or two is None else math.isclose(r.gain, r.quantity * (two - one), abs_tol=1e-9)
    opened = lots.open_lots(df, keys, bought, hot_rows=hot_rows).collect()
    assert Counter((r.holder, r.symbol, r.id, round(r.quantity * 1e6)) for r in opened) == left


def test_gains_add_up(spark):
    df = spark.createDataFrame([
        ("1", "h", "A", START, 10.0, 5.0, "buy"), ("2", "h", "A", START + dt.timedelta(1), 12.0, 5.0, "buy"),
        ("3", "h", "A", START + dt.timedelta(2), 15.0, 7.0, "sell"), ("4", "s", "A", START, 20.0, 2.0, "sell"),
        ("5", "s", "A", START + dt.timedelta(1), 18.0, 3.0, "buy")], FILLS)
    bought = F.col("side") == "buy"
    keys = ["holder", "symbol"]
    quotes = spark.createDataFrame([("A", 20.0)], "symbol string, price double")
    found = {r.holder: r for r in lots.gains(lots.fifo(df, keys, bought), lots.open_lots(df, keys, bought), quotes, keys).collect()}
    assert (found["h"].closed, found["h"].realised) == (7.0, 5 * 5.0 + 2 * 3.0)
    assert (found["h"].open, found["h"].cost, found["h"].open_gain) == (3.0, 36.0, 24.0)
    # A sale before its buy is closed by it.
    assert (found["s"].closed, found["s"].realised, found["s"].open, found["s"].open_gain) == (2.0, 4.0, 1.0, 2.0)


def test_no_fills(spark):
    df = spark.createDataFrame([], FILLS)
    assert lots.fifo(df, ["symbol"], F.col("side") == "buy").isEmpty()
    assert lots.open_lots(df, ["symbol"], F.col("side") == "buy").isEmpty()


def test_lots_plan_has_no_pairing_join(spark):
    df = spark.createDataFrame(fills(2), FILLS)
    plan = lots.fifo(df, ["holder", "symbol"], F.col("side") == "buy")._jdf.queryExecution().executedPlan().toString()
    assert "Join" not in plan and "Python" not in plan


BARS = "symbol string, datetime timestamp, close double, volume int"


def closes(seed, rows=400):
    draw = random.Random(seed)
    return [(draw.choice(["A", "A", "A", "B", None]), START + dt.timedelta(minutes=k),
             draw.choice([None, float("nan"), *[100 + draw.gauss(0, 5) for _ in range(6)]]), k) for k in range(rows)]


def looped(rows, alpha):
    out, state = {}, {}
    for symbol, time, close, _ in sorted(rows, key=lambda r: r[1]):
        mean, variance = state.get(symbol, (None, None))
        if close is not None and close == close:
            gap = 0.0 if mean is None else close - mean
            variance = (1 - alpha) * ((variance or 0.0) + alpha * gap * gap)
            mean = close if mean is None else (1 - alpha) * mean + alpha * close
        state[symbol] = (mean, variance)
        out[symbol, time] = (mean, None if variance is None else math.sqrt(variance))
    return out


def near(one, two):
    return (one is None and two is None) or (one is not None and two is not None and math.isclose(one, two, rel_tol=1e-9, abs_tol=1e-9))


@pytest.mark.parametrize("alpha", [0.03, 0.5, 0.97, 1.0])
@pytest.mark.parametrize("hot_rows", [None, 50])
def test_exponential_equals_the_loop(spark, alpha, hot_rows):
    rows = closes(4)
    found = series.exponential(spark.createDataFrame(rows, BARS), "symbol", alpha, hot_rows=hot_rows).collect()
    expected = looped(rows, alpha)
    assert len(found) == len(rows)
    for r in found:
        average, volatility = expected[r.symbol, r.datetime]
        assert near(r.average, average) and near(r.volatility, volatility), (r, average, volatility)


def test_exponential_over_many_blocks(spark):
    """Blocks of 289 rows at alpha 0.5; a million-fold jump does not leak across them."""
    rows = [("A", START + dt.timedelta(minutes=k), 1e6 if k < 700 else 1.0 + k % 3, k) for k in range(3000)]
    expected = looped(rows, 0.5)
    for hot_rows in (None, 400):
        found = series.exponential(spark.createDataFrame(rows, BARS), "symbol", 0.5, hot_rows=hot_rows).collect()
        assert all(near(r.average, expected["A", r.datetime][0]) for r in found)
    with pytest.raises(ValueError):
        series.exponential(spark.createDataFrame(rows, BARS), "symbol", 0.0)


def test_exponential_of_a_key_that_starts_late(spark):
    rows = [("A", START + dt.timedelta(minutes=k), None if k < 120 else float(k), k) for k in range(200)]
    expected = looped(rows, 0.1)
    for hot_rows in (None, 30):
        found = series.exponential(spark.createDataFrame(rows, BARS), "symbol", 0.1, hot_rows=hot_rows).collect()
        assert all(near(r.average, expected["A", r.datetime][0]) for r in found)
        assert sum(r.average is None for r in found) == 120


WIDE = "symbol string, datetime timestamp, bar_end timestamp, open double, close double"


def test_bars_of_any_length_equal_all_pairs(spark):
    draw = random.Random(6)
    bars, trades = [], []
    for k in range(150):
        start = START + dt.timedelta(seconds=draw.randrange(200_000), milliseconds=draw.choice([0, 0, 250]))
        length = draw.choice([0, -60, 1, 59, 60, 61, 3600, 7261, 86_400])
        bars.append((draw.choice(["A", "B", None]), start, start + dt.timedelta(seconds=length), float(k), 1.0))
    bars += [("A", None, START, 0.0, 0.0), ("A", START, None, 0.0, 0.0)]
    edges = [t for b in bars for t in b[1:3] if t]
    for k in range(600):
        time = draw.choice(edges) if draw.random() < 0.3 else START + dt.timedelta(seconds=draw.randrange(290_000))
        trades.append((f"t{k}", draw.choice(["A", "B", None]), draw.choice([time, time, None])))
    found = joins.to_any_bar(
        spark.createDataFrame(trades, "id string, symbol string, datetime timestamp"), spark.createDataFrame(bars, WIDE),
        "1 second")
    expected = Counter(
        (t[0], b[1], b[2], b[3]) for t in trades for b in bars
        if t[1] is not None and t[1] == b[0] and None not in (t[2], b[1], b[2]) and b[1] <= t[2] < b[2])
    assert Counter((r.id, r.bar_start, r.bar_end, r.bar_open) for r in found.collect()) == expected and expected
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "NestedLoop" not in plan and "Cartesian" not in plan
    none = joins.to_any_bar(
        spark.createDataFrame(trades, "id string, symbol string, datetime timestamp"),
        spark.createDataFrame(bars, WIDE).limit(0), "1 second")
    assert none.isEmpty()


def test_covers_are_exact_and_short(spark):
    spans = spark.range(400).select(F.pmod(F.hash("id"), F.lit(5000)).cast("bigint").alias("a"),
                                    F.pmod(F.hash("id", F.lit(1)), F.lit(5000)).cast("bigint").alias("n"))
    rows = spans.select("a", "n", joins.cover(F.col("a"), F.col("a") + F.col("n"), 14).alias("cover")).collect()
    for row in rows:
        units = Counter(k for block in row.cover for k in range(block.block << block.level, (block.block + 1) << block.level))
        assert units == Counter(range(row.a, row.a + row.n))
        assert len(row.cover) <= 2 * max(1, row.n.bit_length())


@pytest.mark.parametrize("few, method", [(200_000, "BroadcastHashJoin Inner BuildRight"), (0, "SortMergeJoin")])
def test_any_bar_never_broadcasts_the_repeated_trades(spark, monkeypatch, few, method):
    """By file size the trades look like the smaller side; they stand once a level."""
    monkeypatch.setattr(joins, "FEW_BLOCKS", few, raising=False)
    trades = spark.range(3).select(
        F.col("id").cast("string").alias("id"), F.lit("A").alias("symbol"),
        F.timestamp_seconds(F.lit(100) + F.col("id")).alias("datetime"))
    bars = spark.range(2000).select(
        F.lit("A").alias("symbol"), F.timestamp_seconds(F.col("id")).alias("datetime"),
        F.timestamp_seconds(F.col("id") + 50).alias("bar_end"), F.lit(1.0).alias("open"), F.lit(2.0).alias("close"))
    found = joins.to_any_bar(trades, bars, "1 second")
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert " ".join(method.split()[:1]) in plan and method.split()[-1] in plan and "BuildLeft" not in plan
    assert found.count() == 150


def test_gains_shuffle_the_fills_once(spark):
    """Matches and open lots of small keys work inside one layout by key."""
    rows = spark.range(40).select(
        F.pmod("id", F.lit(3)).cast("string").alias("symbol"), F.col("id").alias("datetime"), "id",
        (F.col("id") * 1.0).alias("last_price"), (F.col("id") + 1).alias("volume"), (F.hash("id") % 2 == 0).alias("buy"))
    keys, bought = ["symbol"], F.col("buy")
    shared = lots.counted(rows, keys, bought)
    assert shared.hot_rows is None and lots.counted(rows, keys, bought, hot_rows=5).hot_rows == 5
    for work in (lots.fifo, lots.open_lots):
        found = work(rows, keys, bought, intervals=shared)
        plan = found._jdf.queryExecution().executedPlan().toString()
        assert plan.count("Exchange") == 1 and "Join" not in plan
        assert Counter(found.collect()) == Counter(work(rows, keys, bought, hot_rows=5).collect())


def test_exponential_bounds_a_task_below_other_series(spark):
    """Rows of a key beyond the bound are cut, without being asked to."""
    assert inspect.signature(series.exponential).parameters["hot_rows"].default <= 1_000_000
