"""Stored partials: what a refresh reads, and reports against a full recompute."""

import datetime as dt
import glob
import random

import pytest
from pyspark.sql import functions as F

from quotemill.operators import partials, reports
from quotemill.schemas import TRADE
from quotemill.streaming.sinks import BatchDirectory

START = dt.datetime(2024, 1, 1)


def trades(spark, seed, rows=400):
    draw = random.Random(seed)
    return spark.createDataFrame([
        (f"{seed}-{k}", ["x"], draw.choice([None, float("nan"), draw.random() * 100, 5.0]),
         draw.choice([None, "A", "B", f"S{draw.randrange(40)}"]),
         draw.choice([None, START + dt.timedelta(minutes=draw.randrange(14_400))]), draw.choice([None, 1, 7]))
        for k in range(rows)], TRADE)


@pytest.fixture
def table(tmp_path):
    return BatchDirectory(str(tmp_path / "trades"))


def put(table, rows, query, batch):
    """A batch as the sink of a streaming query writes it."""
    rows.write.mode("overwrite").parquet(f"{table.path}/query_id={query}/batch_id={batch}")


def read(spark, table):
    return table.read(spark, TRADE)


def rounded(df):
    return sorted(map(repr, df.withColumn("notional", F.round("notional", 6)).select(
        "symbol", "day", "level", "trades", "volume", "notional").collect()))


def test_a_refresh_reads_only_new_batches(spark, table, tmp_path):
    store = partials.daily_totals(str(tmp_path / "partials"))
    put(table, trades(spark, 0), "one", 0)
    put(table, trades(spark, 1), "one", 1)
    assert store.refresh(read(spark, table)) == 1
    assert store.refresh(read(spark, table)) == 0
    put(table, trades(spark, 2), "one", 2)
    put(table, trades(spark, 3), "two", 0)
    rows, ahead = store.progress.fresh(read(spark, table))
    assert ahead == {"one": 2, "two": 0}
    # Nothing that was read before is opened.
    assert files_read(rows) == count_files(table, ["query_id=one/batch_id=2", "query_id=two/batch_id=0"])
    assert rows.count() == 800
    assert store.refresh(read(spark, table)) == 2
    assert rounded(partials.rollup_report(store, spark)) == rounded(reports.rollup_report(read(spark, table)))


def count_files(table, parts):
    return sum(len(glob.glob(f"{table.path}/{part}/*.parquet")) for part in parts)


def files_read(df):
    """Files the scan of a query opened."""
    execution = df._jdf.queryExecution()
    execution.toRdd().count()
    plan = execution.executedPlan()
    leaves = plan.collectLeaves()
    return sum(leaves.apply(k).metrics().apply("numFiles").value() for k in range(leaves.size()))


def test_a_run_that_fails_before_its_marks_does_not_count(spark, table, tmp_path, monkeypatch):
    store = partials.daily_totals(str(tmp_path / "partials"))
    put(table, trades(spark, 0), "one", 0)
    store.refresh(read(spark, table))
    put(table, trades(spark, 1), "one", 1)
    # Rows of a run whose marks were never written.
    read(spark, table).groupBy("symbol", F.to_date("datetime").alias("day")).agg(
        *[m.partial.alias(m.name) for m in store.measures]).write.parquet(f"{store.path}/rows/run=2")
    assert store.rows(spark).agg(F.sum("trades")).first()[0] == 400
    store.refresh(read(spark, table))
    assert rounded(partials.rollup_report(store, spark)) == rounded(reports.rollup_report(read(spark, table)))


def test_compaction_keeps_results_and_marks(spark, table, tmp_path):
    store = partials.daily_totals(str(tmp_path / "partials"))
    store.compact(spark)
    for batch in range(3):
        put(table, trades(spark, batch), "one", batch)
        store.refresh(read(spark, table))
    before = rounded(partials.rollup_report(store, spark))
    store.compact(spark)
    assert rounded(partials.rollup_report(store, spark)) == before
    assert [r.run for r in store.progress.marks(spark).collect()] == [4]
    assert store.refresh(read(spark, table)) == 0
    put(table, trades(spark, 9), "one", 3)
    assert store.refresh(read(spark, table)) == 1
    assert rounded(partials.rollup_report(store, spark)) == rounded(reports.rollup_report(read(spark, table)))


def test_symbols_of_a_range_count_once(spark, table, tmp_path):
    store = partials.daily_symbols(str(tmp_path / "partials"))
    for batch in range(3):
        put(table, trades(spark, batch), "one", batch)
        store.refresh(read(spark, table))
    ranges = spark.createDataFrame(
        [(dt.date(2024, 1, a), dt.date(2024, 1, b)) for a, b in ((1, 1), (1, 4), (3, 10), (20, 21))],
        "first date, last date")
    found = {(r.first, r["last"]): (r.symbols, r.trades) for r in
             map(lambda r: Row(r), partials.symbols_between(store, ranges).collect())}
    rows = [r for r in read(spark, table).collect() if r.datetime is not None]
    for first, last in ((1, 1), (1, 4), (3, 10)):
        inside = [r.symbol for r in rows if first <= r.datetime.day <= last]
        assert found[dt.date(2024, 1, first), dt.date(2024, 1, last)] == (len(set(inside) - {None}), len(inside))
    assert len(found) == 3
    plan = partials.symbols_between(store, ranges)._jdf.queryExecution().executedPlan().toString()
    # Only the partials are scanned.
    assert table.path not in plan and "NestedLoop" not in plan


class Row:
    """A row whose field ``first`` is read by name, not as a method."""

    def __init__(self, row):
        self.__dict__.update(row.asDict())

    def __getitem__(self, name):
        return self.__dict__[name]


def test_large_sets_stay_within_the_sketch_error(spark, tmp_path, table):
    rows = spark.range(200_000).select(
        F.col("id").cast("string").alias("id"), F.array(F.lit("x")).alias("trade_conditions"),
        F.lit(1.0).cast("float").alias("last_price"), (F.col("id") % 60_000).cast("string").alias("symbol"),
        F.lit(START).alias("datetime"), F.lit(1).alias("volume"))
    put(table, rows, "one", 0)
    store = partials.daily_symbols(str(tmp_path / "partials"))
    store.refresh(read(spark, table))
    other = rows.where("id % 60000 < 20000").agg(F.theta_sketch_agg("symbol", 14).alias("symbols"))
    found = partials.symbols_in_both(store.rows(spark), other).first()
    # One deviation of a sketch with 2^14 entries is 0.8 %, of an intersection a third the size some more.
    assert abs(found.left_symbols - 60_000) < 0.03 * 60_000
    assert abs(found.right_symbols - 20_000) < 0.03 * 20_000
    assert abs(found.both - 20_000) < 0.08 * 20_000


def test_percentiles_of_a_range_keep_the_rank_error(spark, table, tmp_path):
    store = partials.daily_prices(str(tmp_path / "partials"))
    rows = spark.range(300_000).select(
        F.col("id").cast("string").alias("id"), F.array(F.lit("x")).alias("trade_conditions"),
        # A long tail, so that a wrong rank shows as a wrong price.
        F.exp(F.rand(5) * 12).cast("float").alias("last_price"), F.lit("A").alias("symbol"),
        (F.lit(START) + F.make_dt_interval(mins=(F.col("id") % 14_400).cast("int"))).alias("datetime"),
        F.lit(1).alias("volume"))
    for batch in range(4):
        put(table, rows.where(F.col("id") % 4 == batch).unionByName(trades(spark, batch)), "one", batch)
        store.refresh(read(spark, table))
    percents = (1, 10, 50, 90, 99)
    found = {r.symbol: r for r in partials.price_percentiles(store, spark, "2024-01-02", "2024-01-06", percents).collect()}
    inside = [r for r in read(spark, table).select("symbol", "last_price", "datetime").collect()
              if r.datetime is not None and 2 <= r.datetime.day <= 6]
    prices = sorted(r.last_price for r in inside if r.symbol == "A" and r.last_price is not None and r.last_price == r.last_price)
    assert found["A"].n == len(prices) > 100_000
    for p in percents:
        value = found["A"][f"p{p}"]
        below, upto = (sum(x < value for x in prices), sum(x <= value for x in prices))
        assert below / len(prices) - 0.01 <= p / 100 <= upto / len(prices) + 0.01


def test_no_table_yet(spark, table, tmp_path):
    store = partials.daily_totals(str(tmp_path / "partials"))
    empty = spark.createDataFrame([], read_schema())
    assert store.refresh(empty) == 0
    assert store.progress.marks(spark).isEmpty()


def read_schema():
    from pyspark.sql import types as T

    from quotemill.streaming.sinks import RUN
    return T.StructType([*TRADE.fields, *RUN.fields])


def test_last_versions_equal_reading_all_of_them(spark, tmp_path):
    from quotemill.streaming import windows
    schema = "symbol string, datetime timestamp, close double, trades bigint"
    sink = BatchDirectory(str(tmp_path / "bars"))
    store = partials.last_versions(str(tmp_path / "partials"), ["symbol", "datetime"], ["close", "trades"])
    draw = random.Random(8)
    whole = spark.createDataFrame([], schema).schema
    for batch in range(5):
        rows = {(draw.choice(["A", "B", None]), START + dt.timedelta(hours=draw.randrange(6))) for _ in range(9)}
        put(sink, spark.createDataFrame([(*key, draw.choice([None, draw.random()]), batch) for key in rows], schema), "one", batch)
        if batch % 2:
            store.refresh(sink.read(spark, whole))
    store.refresh(sink.read(spark, whole))
    expected = sorted(map(repr, windows.current(sink.read(spark, whole), ["symbol", "datetime"]).collect()))
    assert sorted(map(repr, partials.current(store, spark).collect())) == expected
    store.compact(spark)
    assert sorted(map(repr, partials.current(store, spark).collect())) == expected


def test_partials_and_compaction_of_the_catalog_table(spark, tmp_path):
    """The job's own table, partitioned by run and day, is read batch by batch as well."""
    from quotemill.sources.feeds import TRADES
    from quotemill.streaming import sinks
    from quotemill.streaming.compaction import BucketedTable
    name = f"partials_{tmp_path.name}"
    sinks.create_database(spark, name, str(tmp_path / "db"))
    table = sinks.create_table(spark, TRADES, name)
    sink = sinks.CatalogTable(table)
    store = partials.daily_totals(str(tmp_path / "partials"))
    moved = BucketedTable(f"{name}.by_symbol", str(tmp_path / "marks"), buckets=4)
    for batch in range(3):
        sink.write(trades(spark, batch), batch)
        assert store.refresh(spark.table(table)) == 1
        assert moved.compact(spark.table(table)) == 1
        # A batch that is repeated, as after a restart, is not read twice.
        sink.write(trades(spark, batch), batch)
        assert store.refresh(spark.table(table)) == 0
    assert rounded(partials.rollup_report(store, spark)) == rounded(reports.rollup_report(spark.table(table)))
    assert sorted(map(repr, moved.read(spark).select(*TRADE.names).collect())) == sorted(
        map(repr, spark.table(table).select(*TRADE.names).collect()))
