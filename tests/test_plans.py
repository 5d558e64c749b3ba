"""Plan shapes that keep the reports cheap on large tables."""

import pytest
from pyspark.sql import functions as F

from quotemill.operators import bars, joins, ranking, reports, series
from quotemill.plans import analytics, ingestion, inputs
from quotemill.sources.feeds import TRADES
from quotemill.streaming.jobs import table_rows


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


def exchanges(df):
    return plan_of(df).count("Exchange hashpartitioning") + plan_of(df).count("Exchange rangepartitioning")


@pytest.fixture(scope="module")
def trades(spark, sf_dir):
    return inputs.trades(inputs.events(spark, sf_dir))


def test_ingest_has_no_shuffle(spark, sf_dir):
    messages = ingestion.trade_messages(spark, sf_dir)
    assert "Exchange" not in plan_of(table_rows(messages, TRADES))


def test_checks_have_no_shuffle(spark, sf_dir):
    assert "Exchange" not in plan_of(ingestion.quarantined_trades(spark, sf_dir))


def test_only_needed_columns_are_read(trades):
    plan = plan_of(bars.vwap(trades, "symbol"))
    schema = plan[plan.index("ReadSchema"):].split("\n")[0]
    assert "user_id" in schema and "value" in schema
    assert "props" not in schema and "event_type" not in schema and "event_id" not in schema


def test_filters_reach_the_scan(spark, sf_dir):
    rows = inputs.fills(spark, sf_dir).where(F.col("quantity") >= 45)
    assert "GreaterThanOrEqual(l_quantity,45.0)" in plan_of(rows)


def test_one_shuffle_per_aggregation(trades):
    assert exchanges(bars.ohlcv(trades, "1 hour")) == 1
    assert exchanges(bars.vwap(trades, "symbol")) == 1
    assert exchanges(reports.condition_breakdown(trades)) == 1


def test_windows_on_one_key_share_a_shuffle(spark, sf_dir):
    # One for the bars, one for both windows of the adjustment.
    assert exchanges(analytics.g22_adjusted_closes(spark, sf_dir)) == 2


def test_aggregations_combine_before_the_shuffle(trades):
    above, below = plan_of(bars.ohlcv(trades, "1 hour")).split("Exchange", 1)
    assert "partial_max_by" in below and "partial_" not in above


def test_latest_sorts_only_the_rows_of_the_last_time(trades):
    plan = plan_of(ranking.latest(trades, "symbol"))
    # Tied rows are sorted above the join; all rows only go through a hash aggregation.
    assert plan.count("SortAggregate") == 2 and plan.index("SortAggregate") < plan.index("LeftSemi")
    assert "SortAggregate" not in plan[plan.index("LeftSemi"):]
    assert "partial_max(datetime" in plan
    executed = ranking.latest(trades, "symbol")
    executed.collect()
    assert "BroadcastHashJoin" in plan_of(executed)


def test_top_k_limits_before_the_shuffle(trades):
    daily = ranking.movers(bars.ohlcv(trades, "1 day"))
    assert "TakeOrderedAndProject" in plan_of(ranking.top(daily, 5, "change", ["symbol"]))
    per_day = ranking.top_per_group(daily, 5, "datetime", "change", ["symbol"])
    above, below = plan_of(per_day).split("Exchange hashpartitioning(datetime", 1)
    assert "WindowGroupLimit" in above and "WindowGroupLimit" in below


def jobs_of(spark, build):
    """Jobs that building a query runs, by a job group of its own."""
    group = f"build-{id(build)}"
    spark.sparkContext.setJobGroup(group, "building")
    try:
        build()
        return len(spark.sparkContext.statusTracker().getJobIdsForGroup(group))
    finally:
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)


def test_lookups_run_no_job_ahead(spark, sf_dir, trades):
    """Building a join counts nothing; reading a table's schema is a job of its own."""
    fills, orders = inputs.fills(spark, sf_dir), inputs.orders(spark, sf_dir)
    quotes = ranking.latest(trades, "symbol").select("symbol", F.col("last_price").alias("price"))
    assert jobs_of(spark, lambda: joins.valuation(joins.positions(orders, fills), quotes)) == 0
    assert jobs_of(spark, lambda: reports.outliers(trades, "symbol", "last_price")) == 0


def test_split_plans_read_their_input_once(spark, trades):
    """With a large key the input is kept in the shared folder, not read by either side."""
    rows = trades.select("id", "symbol", "datetime", "last_price")
    split = series.moving(rows, "symbol", 5, price="last_price", ties=("id",), hot_rows=20)
    assert plan_of(split).count("FileScan") == 0


def test_large_k_is_numbered_in_pieces(trades):
    few = ranking.top_per_group(trades, 1500, "symbol", "last_price", ["id"], hot_rows=20)
    window = ranking.top_per_group(trades, 999, "symbol", "last_price", ["id"])
    assert few.count() == window.count() == trades.count()
    places = few.select("symbol", "id", "place").collect()
    assert sorted(map(tuple, places)) == sorted(map(tuple, window.select("symbol", "id", "place").collect()))


def test_both_rankings_order_nulls_and_not_a_number_alike(spark):
    scores = [None, float("nan"), float("inf"), float("-inf"), None, float("nan")] + [float(k % 400) for k in range(1100)]
    rows = spark.createDataFrame([("A", k, score) for k, score in enumerate(scores)], "name string, id int, score double")
    window, pieces = (
        {r.place: r.id for r in ranking.top_per_group(rows, k, "name", "score", ["id"], hot_rows=20).collect()}
        for k in (999, 1000))
    assert len(window) == 999 and len(pieces) == 1000
    assert window == {place: pieces[place] for place in window}
    assert [pieces[place] for place in (1, 2, 3)] == [1, 5, 2]


def test_a_long_gap_fits_no_array(spark):
    rows = spark.createDataFrame(
        [("A", 0, 1.0, 1), ("A", 3_000_000, 2.0, 1), ("B", 7, 1.0, 1)], "symbol string, s bigint, close double, volume int")
    bars_apart = rows.withColumn("datetime", F.timestamp_seconds("s")).drop("s")
    filled = series.fill(bars_apart, "symbol", 60)
    assert filled.count() == 50_001 + 1
    assert filled.where("filled").agg(F.min("close"), F.max("close")).first() == (1.0, 1.0)


@pytest.mark.parametrize("scale", [1e-6, 1.0, 1e9])
def test_prices_of_any_size(spark, scale):
    prices = [1.234, 1.266, None, float("nan"), 3.5]
    rows = spark.createDataFrame(
        [(str(n), "A", None if p is None else p * scale, 100 * (n + 1), n) for n, p in enumerate(prices)],
        "id string, symbol string, last_price double, volume int, s int").withColumn("datetime", F.timestamp_seconds("s"))
    row = bars.vwap(rows, "symbol").first()
    right = (1.234 * 100 + 1.266 * 200 + 3.5 * 500) / 800
    assert row.vwap / scale == pytest.approx(right) and row.volume == 800 and row.trades == 5
    slid = bars.sliding_stats(rows, 60, 60).first()
    assert slid.avg_price / scale == pytest.approx(2.0) and slid.high / scale == pytest.approx(3.5)
    bar = bars.ohlcv(rows.where("s in (0, 2, 3)"), "1 minute").first()
    assert (bar.open, bar.high, bar.close, bar.trades) == (1.234 * scale, 1.234 * scale, 1.234 * scale, 3)
    moved = series.moving(rows.where("s < 2"), "symbol", 2, price="last_price", ties=("id",)).collect()
    assert max(r.moving_avg for r in moved) / scale == pytest.approx(1.25)
    scores = [r.zscore for r in reports.zscores(rows.where("s < 2"), "symbol", "last_price").collect()]
    assert sorted(scores) == pytest.approx([-(0.5 ** 0.5), 0.5 ** 0.5])


def test_huge_trades_do_not_end_the_job(spark):
    rows = spark.createDataFrame([("1", "A", 2e14, 2_000_000_000)], "id string, symbol string, last_price double, volume int")
    assert bars.vwap(rows, "symbol").first().vwap == pytest.approx(2e14)
