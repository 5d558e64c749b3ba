"""Compaction of stored batches: rows kept once, and no shuffle for work on the symbol."""

import datetime as dt
import random
from collections import Counter

import pytest
from pyspark.sql import functions as F

from quotemill.operators import bars, joins, series
from quotemill.schemas import TRADE
from quotemill.streaming import sinks
from quotemill.streaming.compaction import BucketedTable

START = dt.datetime(2024, 1, 1)


def trades(spark, seed, rows=500):
    draw = random.Random(seed)
    return spark.createDataFrame([
        (f"{seed}-{k}", ["x"], draw.random(), draw.choice(["hot", "hot", "A", "B", None]),
         draw.choice([None, *[START + dt.timedelta(minutes=draw.randrange(4000)) for _ in range(9)]]), k)
        for k in range(rows)], TRADE)


@pytest.fixture
def tables(spark, tmp_path):
    name = f"compaction_{tmp_path.name}"
    sinks.create_database(spark, name, str(tmp_path / "db"))
    return sinks.BatchDirectory(str(tmp_path / "trades")), BucketedTable(f"{name}.trades", str(tmp_path / "marks"), buckets=4)


def put(folder, rows, query, batch):
    rows.write.mode("overwrite").parquet(f"{folder.path}/query_id={query}/batch_id={batch}")


def rows_of(df):
    return Counter(map(repr, df.select(*TRADE.names).collect()))


@pytest.mark.parametrize("hot_rows", [5_000_000, 100])
def test_rows_are_moved_once(spark, tables, hot_rows):
    folder, table = tables
    for batch in range(3):
        put(folder, trades(spark, batch), "one", batch)
        if batch:
            assert table.compact(folder.read(spark, TRADE), hot_rows=hot_rows) == 1
    put(folder, trades(spark, 9), "two", 0)
    assert table.compact(folder.read(spark, TRADE), hot_rows=hot_rows) == 1
    assert table.compact(folder.read(spark, TRADE), hot_rows=hot_rows) == 0
    assert rows_of(table.read(spark)) == rows_of(folder.read(spark, TRADE))
    # One file a bucket and day at most for ordinary symbols; far fewer than batches and tasks wrote.
    assert spark.table(table.table).select("run").distinct().count() == 3


def test_a_run_that_fails_before_its_marks_is_replaced(spark, tables, monkeypatch):
    from quotemill.operators.partials import Progress
    folder, table = tables
    put(folder, trades(spark, 0), "one", 0)
    table.compact(folder.read(spark, TRADE))
    put(folder, trades(spark, 1), "one", 1)
    monkeypatch.setattr(Progress, "commit", lambda *a, **k: 1 / 0)
    with pytest.raises(ZeroDivisionError):
        table.compact(folder.read(spark, TRADE))
    monkeypatch.undo()
    # Its rows are there, but do not count.
    assert spark.table(table.table).count() == 1000 and table.read(spark).count() == 500
    table.compact(folder.read(spark, TRADE))
    assert rows_of(table.read(spark)) == rows_of(folder.read(spark, TRADE))


def test_work_on_the_symbol_needs_no_shuffle(spark, tables):
    folder, table = tables
    for batch in range(2):
        put(folder, trades(spark, batch), "one", batch)
        table.compact(folder.read(spark, TRADE))
    stored = table.read(spark).select("id", "symbol", "datetime", "last_price", "volume")
    quotes = table.table.replace(".trades", ".bars")
    hourly = bars.ohlcv(stored.where("datetime is not null"), "1 hour")
    hourly.select("symbol", "datetime", "close").repartition(4, "symbol").write.format("parquet").bucketBy(
        4, "symbol").sortBy("symbol", "datetime").saveAsTable(quotes)
    for made in (
        joins.as_of(stored, spark.table(quotes)),
        series.running(stored, ["symbol"]),
        series.exponential(stored, "symbol", 0.1, price="last_price", ties=("id",)),
        bars.vwap(stored, "symbol"),
    ):
        plan = made._jdf.queryExecution().executedPlan().toString()
        assert "Exchange" not in plan, plan
    plain = folder.read(spark, TRADE).select("id", "symbol", "datetime", "last_price", "volume")
    expected = joins.as_of(plain, hourly.select("symbol", "datetime", "close"))
    found = joins.as_of(stored, spark.table(quotes))
    assert Counter(map(repr, found.collect())) == Counter(map(repr, expected.collect()))


def test_nothing_stored_yet(spark, tables):
    folder, table = tables
    empty = spark.createDataFrame([], TRADE).withColumns({"query_id": F.lit("q"), "batch_id": F.lit(0).cast("bigint")})
    assert table.compact(empty) == 0
    assert not spark.catalog.tableExists(table.table)
