"""Registered queries of the reports over stored trades and bars."""

from __future__ import annotations

import uuid
from collections.abc import Callable, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from quotemill.operators import bars, gate, joins, lots, partials, ranking, records, reports, series
from quotemill.plans import inputs
from quotemill.plans.inputs import FILL_TIES, wall_time
from quotemill.session import scratch_path, shared_dir
from quotemill.sources.feeds import BARS, TRADES
from quotemill.sources.topics import FileTopics
from quotemill.streaming import joins as stream_joins
from quotemill.streaming import compaction, sinks, windows
from quotemill.streaming.jobs import ingest, run, table_rows

# Bars built here hold one row per symbol and hour or day, so a symbol has at
# most 8,784 rows a year and its window needs no split.
BOUNDED = None


def _trades(spark: SparkSession, sf_dir: str, symbol: str = "user_id") -> DataFrame:
    return inputs.trades(inputs.events(spark, sf_dir), symbol)


def _hourly(spark: SparkSession, sf_dir: str, symbol: str = "user_id") -> DataFrame:
    return bars.ohlcv(_trades(spark, sf_dir, symbol), "1 hour")


def _closes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Hourly closes per user; all that the series below need of a bar."""
    return _hourly(spark, sf_dir).select("symbol", "datetime", "close", "volume")


# Rows of one delivered file. A part with more is dealt over several files, so that tasks share it.
FILE_ROWS = 100_000

# Dealing this many rows to a file leaves no file without any.
LEAST_ROWS = 1_000

# Files of a part at most; a file stream keeps 10,000 of those it has listed.
MOST_FILES = 200


def _deliver(
    rows: DataFrame, part: Column, order: Sequence[int], path: str,
    shape: Callable[[DataFrame], DataFrame] = lambda rows: rows,
) -> int:
    """Writes the parts of the rows in the given order; tells how many files each has.

    All parts have equally many, so a stream that takes that many files a
    micro-batch gets one part a micro-batch. Rows are dealt before ``shape``
    is applied, so that their number of tasks follows the rows and not the layout of the input.
    """
    counted = rows.groupBy(part.alias("part")).agg(F.count(F.lit(1)).alias("n"))
    sizes = {row["part"]: row["n"] for row in counted.where(F.col("part").isin(*order)).collect()}
    most, least = max(sizes.values(), default=0), min(sizes.values(), default=0)
    files = max(1, min(-(-most // FILE_ROWS), least // LEAST_ROWS, MOST_FILES))
    for number in [number for number in order if number in sizes] or order[:1]:
        shape(rows.where(part == number).repartition(files)).write.mode("append").parquet(path)
    return files


def _in_files(spark: SparkSession, sf_dir: str, order: tuple[int, ...]) -> FileTopics:
    """The trade messages in five parts by time, delivered in the given order, one per micro-batch."""
    path = scratch_path(spark, "topic")
    events = inputs.events(spark, sf_dir)
    last = events.agg(F.max("event_id")).first()[0] or 0
    part = F.floor(F.col("event_id") * len(set(order)) / (last + 1))
    files = _deliver(events, part, order, path, inputs.trade_messages)
    return FileTopics(path, max_files_per_trigger=files)


IN_ORDER, OUT_OF_ORDER = (0, 1, 2, 3, 4), (3, 0, 4, 1, 2)


def _trade_stream(spark: SparkSession, sf_dir: str, order: tuple[int, ...]) -> DataFrame:
    stream = _in_files(spark, sf_dir, order).read_stream(spark, TRADES.topic)
    return table_rows(stream, TRADES).drop("trade_conditions")


def _parts(
    rows: DataFrame, time: str, path: str, bounds: tuple[int, int], closing: DataFrame,
    shape: Callable[[DataFrame], DataFrame] = lambda rows: rows,
) -> int:
    """Files by time, in order, with one row long after all others at the end; tells the files of a micro-batch.

    The last row only moves the watermark, so that what it closes is written.
    """
    low, high = bounds
    part = F.floor((F.unix_millis(time) - low) * 3 / (high - low + 1))
    files = _deliver(rows, part, (0, 1, 2), path, shape)
    shape(closing.coalesce(1)).write.mode("append").parquet(path)
    return files


def _running(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """The trades by event type and a provider's bars of them, as two streams that move on together."""
    events = inputs.events(spark, sf_dir)
    shared_dir(spark)
    # Counted, dealt in parts and closed; built once.
    provided = _provided(spark, sf_dir).select("symbol", "datetime", *BAR_VALUES).checkpoint()
    hour = F.date_trunc("hour", F.min("ts"))
    low, high = events.agg(F.unix_millis(hour), F.unix_millis(F.max("ts"))).first()
    bounds = (low or 0, high or 0)
    later = F.expr("INTERVAL 1 YEAR")
    last = events.orderBy(F.desc("event_id")).limit(1).withColumns({
        "event_id": F.col("event_id") + 1, "ts": F.col("ts") + later})
    topic, bars_path = scratch_path(spark, "topic"), scratch_path(spark, "bars")
    files = _parts(events, "ts", topic, bounds, last, inputs.trade_messages)
    bar_files = _parts(
        provided, "datetime", bars_path, bounds,
        provided.orderBy(F.desc("datetime")).limit(1).withColumn("datetime", F.col("datetime") + later))
    stored = table_rows(FileTopics(topic, max_files_per_trigger=files).read_stream(spark, TRADES.topic), TRADES)
    trades = stored.withColumn("symbol", F.col("trade_conditions")[0]).drop("trade_conditions")
    bar_stream = spark.readStream.schema(provided.schema).option("maxFilesPerTrigger", bar_files).parquet(bars_path)
    return trades, bar_stream


BAR_VALUES = ("open", "high", "low", "close", "volume")


def _streamed(spark: SparkSession, rows: DataFrame, mode: str) -> DataFrame:
    """Runs a stream to the end of its input and reads what it wrote."""
    sink = sinks.BatchDirectory(scratch_path(spark, "stream"))
    run(windows.start(rows, sink, scratch_path(spark, "offsets"), mode=mode))
    return sink.read(spark, rows.schema)


def g01_encode_messages(spark, sf_dir):
    messages = inputs.trade_messages(inputs.events(spark, sf_dir))
    return messages.select("topic", "offset", F.col("value").cast("string").alias("message"))


def g02_quarantine_counts(spark, sf_dir):
    messages = inputs.flawed_messages(inputs.events(spark, sf_dir))
    return gate.with_reason(messages, TRADES).groupBy(
        F.coalesce("reason", F.lit("stored")).alias("side")
    ).agg(F.count(F.lit(1)).alias("messages"))


def g03_unique_trades(spark, sf_dir):
    """All trades delivered twice; each stays once."""
    trades = _trades(spark, sf_dir).drop("trade_conditions")
    return wall_time(records.unique(trades.unionByName(trades)))


def g03_unique_trades_stream(spark, sf_dir):
    """Files out of order, two of them delivered twice; each trade is kept once."""
    rows = records.unique(_trade_stream(spark, sf_dir, (*OUT_OF_ORDER, 0, 3)), "1 day")
    return wall_time(_streamed(spark, rows, "append").drop("query_id", "batch_id"))


def g04_unified_quotes(spark, sf_dir):
    trades = _trades(spark, sf_dir, "event_type")
    provided = bars.ohlcv(trades, "1 hour").withColumnRenamed("symbol", "ticker").withColumn(
        "id", F.concat_ws("@", "ticker", F.unix_seconds("datetime")))
    return wall_time(records.quotes(trades, provided))


def g05_ohlcv_bars(spark, sf_dir):
    return wall_time(_hourly(spark, sf_dir))


def g05_ohlcv_bars_stream(spark, sf_dir):
    """Hourly bars kept up to date while files come out of order; the last version of each."""
    rows = windows.bars(_trade_stream(spark, sf_dir, OUT_OF_ORDER), "1 hour")
    return wall_time(windows.current(_streamed(spark, rows, "update"), ["symbol", "datetime"]))


def g05_bar_ladder_stream(spark, sf_dir):
    """Bars of one, five and sixty minutes in one stream, each width made of the one before."""
    trades, _ = _running(spark, sf_dir)
    rows = windows.rungs(trades, ("1 minute", "5 minutes", "1 hour"), "1 hour")
    return wall_time(_streamed(spark, rows, "append").drop("query_id", "batch_id"))


def g05_ohlcv_bars_daily_fills(spark, sf_dir):
    return wall_time(bars.ohlcv(inputs.fills(spark, sf_dir), "1 day", ties=FILL_TIES))


def g06_sliding_stats(spark, sf_dir):
    rows = bars.sliding_stats(_trades(spark, sf_dir), 7200, 3600)
    return wall_time(rows.withColumn("avg_price", F.round("avg_price", 9)))


def _stored_flawed(spark, sf_dir):
    """Rows of the trade table that miss prices, volumes, times or symbols."""
    return table_rows(inputs.flawed_messages(inputs.events(spark, sf_dir)), TRADES)


def g06_sliding_stats_flawed(spark, sf_dir):
    rows = bars.sliding_stats(_stored_flawed(spark, sf_dir), 7200, 3600)
    return wall_time(rows.withColumn("avg_price", F.round("avg_price", 9)))


def g07_sessions(spark, sf_dir):
    # One row per symbol and three hours at most after merging.
    return wall_time(bars.sessions(_trades(spark, sf_dir), 10_800, hot_rows=BOUNDED))


def g07_sessions_stream(spark, sf_dir):
    """Sessions that ended an hour before the last trade; each is written once."""
    rows = windows.sessions(_trade_stream(spark, sf_dir, IN_ORDER), "3 hours", "1 hour")
    return wall_time(_streamed(spark, rows, "append").drop("query_id", "batch_id"))


def g08_resample_bars(spark, sf_dir):
    return wall_time(bars.resample(_hourly(spark, sf_dir), "1 day"))


def g09_vwap(spark, sf_dir):
    return bars.vwap(_trades(spark, sf_dir), "symbol").withColumn("vwap", F.round("vwap", 9))


def g09_vwap_flawed(spark, sf_dir):
    return bars.vwap(_stored_flawed(spark, sf_dir), "symbol").withColumn("vwap", F.round("vwap", 9))


def g09_vwap_scaled(spark, sf_dir):
    """Very small and very large prices, scaled back for the report."""
    scaled = _trades(spark, sf_dir).withColumn("scale", F.explode(F.array(F.lit(1e-6), F.lit(1e9))))
    rows = bars.vwap(scaled.withColumn("last_price", F.col("last_price") * F.col("scale")), "symbol", "scale")
    return rows.withColumn("vwap", F.round(F.col("vwap") / F.col("scale"), 9))


def g09_vwap_fills(spark, sf_dir):
    by_day = F.to_date("datetime").alias("day")
    return bars.vwap(inputs.fills(spark, sf_dir), "symbol", by_day).withColumn("vwap", F.round("vwap", 9))


def g10_returns(spark, sf_dir):
    rows = series.returns(_closes(spark, sf_dir), "symbol", price="close", hot_rows=BOUNDED)
    return wall_time(rows.withColumn("log_return", F.round("log_return", 9)))


def g10_returns_stored(spark, sf_dir):
    """Returns on the adjusted close of the stored bars."""
    stored = table_rows(inputs.bar_messages(inputs.events(spark, sf_dir)), BARS)
    rows = series.returns(
        stored.select("ticker", "datetime", F.col("adj_close").cast("double").alias("adj_close")),
        "ticker", hot_rows=BOUNDED)
    return wall_time(rows.withColumns({
        c: F.round(c, 6) for c in ("adj_close", "simple_return", "log_return")}))


def g11_moving_stats(spark, sf_dir):
    rows = series.moving(_closes(spark, sf_dir), "symbol", 5, hot_rows=BOUNDED)
    return wall_time(rows.withColumns({"moving_avg": F.round("moving_avg", 9), "volatility": F.round("volatility", 6)}))


def g11_moving_stats_trades(spark, sf_dir):
    """The last 20 trades of each event type, straight from the trades."""
    trades = _trades(spark, sf_dir, "event_type").select("id", "symbol", "datetime", "last_price")
    rows = series.moving(trades, "symbol", 20, price="last_price", ties=("id",))
    return wall_time(rows.withColumns({"moving_avg": F.round("moving_avg", 9), "volatility": F.round("volatility", 6)}))


def g11_exponential(spark, sf_dir):
    rows = series.exponential(_closes(spark, sf_dir), "symbol", 0.1837, hot_rows=BOUNDED)
    return wall_time(rows.withColumns({c: F.round(c, 7) for c in ("average", "volatility")}))


def g11_exponential_trades(spark, sf_dir):
    """Straight from the trades of each event type, which may be cut into pieces."""
    trades = _trades(spark, sf_dir, "event_type").select("id", "symbol", "datetime", "last_price")
    rows = series.exponential(trades, "symbol", 0.0613, price="last_price", ties=("id",))
    return wall_time(rows.withColumns({c: F.round(c, 7) for c in ("average", "volatility")}))


def g12_running_totals(spark, sf_dir):
    trades = _trades(spark, sf_dir, "event_type").drop("trade_conditions").withColumn(
        "day", F.to_date("datetime"))
    return wall_time(series.running(trades, ["symbol", "day"]))


def g13_ranks(spark, sf_dir):
    """Users ranked by the day's change."""
    trades = _trades(spark, sf_dir)
    daily = ranking.movers(bars.ohlcv(trades, "1 day"))
    rows = daily.select("symbol", F.to_date("datetime").alias("day"), "change")
    probe = trades.select(F.to_date("datetime").alias("day"))
    return ranking.ranks(rows, "day", "change", ["symbol"], probe=probe)


def g13_top_movers(spark, sf_dir):
    daily = ranking.movers(bars.ohlcv(_trades(spark, sf_dir), "1 day"))
    rows = daily.select("symbol", "datetime", "change")
    return wall_time(ranking.top(rows, 25, "change", ["symbol", "datetime"]))


def g13_top_movers_daily(spark, sf_dir):
    daily = ranking.movers(bars.ohlcv(_trades(spark, sf_dir), "1 day"))
    rows = daily.select("symbol", F.to_date("datetime").alias("day"), "change")
    return ranking.top_per_group(rows, 5, "day", "change", ["symbol"])


def g14_latest_quotes(spark, sf_dir):
    return wall_time(ranking.latest(_trades(spark, sf_dir).drop("trade_conditions"), "symbol"))


def g15_condition_breakdown(spark, sf_dir):
    trades = inputs.events(spark, sf_dir).select(
        F.floor("value").cast("int").alias("volume"),
        F.when(F.col("event_type") == "error", F.array().cast("array<string>"))
        .when(F.col("event_type") == "view", F.lit(None))
        .when(F.col("event_type") == "click", F.array("event_type", F.lit("odd_lot")))
        .otherwise(F.array("event_type")).alias("trade_conditions"),
    )
    return reports.condition_breakdown(trades)


def g15_with_condition(spark, sf_dir):
    trades = reports.with_condition(_trades(spark, sf_dir), "purchase")
    return wall_time(trades.drop("trade_conditions"))


def g16_rollup_report(spark, sf_dir):
    return reports.rollup_report(_trades(spark, sf_dir)).withColumn("notional", F.round("notional", 4))


def _kept_up(spark: SparkSession, sf_dir: str, make: Callable[[str], partials.Store]) -> partials.Store:
    """Partials of the stored trades, refreshed each time the table has grown."""
    topic, offsets = scratch_path(spark, "topic"), scratch_path(spark, "offsets")
    sink = sinks.BatchDirectory(scratch_path(spark, "trades"))
    store = make(scratch_path(spark, "partials"))
    messages = inputs.trade_messages(inputs.events(spark, sf_dir))
    last = messages.agg(F.max("offset")).first()[0] or 0
    for part in range(3):
        messages.where(F.floor(F.col("offset") * 3 / (last + 1)) == part).write.mode("append").parquet(topic)
        run(ingest(FileTopics(topic).read_stream(spark, TRADES.topic), TRADES, sink, offsets))
        store.refresh(sink.read(spark, TRADES.row))
    return store


def g16_rollup_incremental(spark, sf_dir):
    """The rollup from partials that each read only the batches written since the last."""
    store = _kept_up(spark, sf_dir, partials.daily_totals)
    return partials.rollup_report(store, spark).withColumn("notional", F.round("notional", 4))


RANGES = (("2024-01-01", "2024-01-03"), ("2024-01-02", "2024-01-20"), ("2024-01-01", "2024-12-31"))


def g17_symbols_by_range(spark, sf_dir):
    """Different symbols in ranges of days, from daily sketches."""
    store = _kept_up(spark, sf_dir, partials.daily_symbols)
    ranges = spark.createDataFrame(RANGES, "first string, last string").select(
        F.to_date("first").alias("first"), F.to_date("last").alias("last"))
    return partials.symbols_between(store, ranges)


def g17_distinct_symbols(spark, sf_dir):
    return reports.distinct_symbols(_trades(spark, sf_dir))


def g17_approx_distinct_symbols(spark, sf_dir):
    """Days, and whether the estimate is within a tenth of the exact number."""
    trades = _trades(spark, sf_dir)
    exact = reports.distinct_symbols(trades).withColumnRenamed("symbols", "exact")
    both = reports.approx_distinct_symbols(trades).join(exact, "day")
    allowed = F.greatest(F.lit(1.0), 0.1 * F.col("exact"))
    return both.select("day", (F.abs(F.col("symbols") - F.col("exact")) <= allowed).alias("close"))


def g18_as_of_bar_compacted(spark, sf_dir):
    """The join on a table that compaction has laid out by symbol, without a shuffle."""
    topic, offsets = scratch_path(spark, "topic"), scratch_path(spark, "offsets")
    sink = sinks.BatchDirectory(scratch_path(spark, "trades"))
    database = f"compacted_{uuid.uuid4().hex}"
    sinks.create_database(spark, database, scratch_path(spark, database))
    table = compaction.BucketedTable(f"{database}.trades", scratch_path(spark, "marks"), "symbol", buckets=4)
    messages = inputs.trade_messages(inputs.events(spark, sf_dir).withColumn("user_id", F.col("event_type")))
    for half in (0, 1):
        messages.where(F.col("offset") % 2 == half).write.mode("append").parquet(topic)
        run(ingest(FileTopics(topic).read_stream(spark, TRADES.topic), TRADES, sink, offsets))
        table.compact(sink.read(spark, TRADES.row))
    provided = f"{database}.bars"
    _provided(spark, sf_dir).select("symbol", "datetime", "close").repartition(4, "symbol").write.format(
        "parquet").bucketBy(4, "symbol").sortBy("symbol", "datetime").saveAsTable(provided)
    trades = table.read(spark).select("id", "symbol", "datetime", "last_price")
    return wall_time(joins.as_of(trades, spark.table(provided), probe=trades.select("symbol")))


def _provided(spark, sf_dir):
    """Bars of a provider that only sees trades with a volume."""
    trades = _trades(spark, sf_dir, "event_type").where(F.col("volume") > 0)
    return bars.ohlcv(trades, "1 hour")


def g18_as_of_bar(spark, sf_dir):
    trades = _trades(spark, sf_dir, "event_type").select("id", "symbol", "datetime", "last_price")
    provided = _provided(spark, sf_dir).select("symbol", "datetime", "close")
    # There are fewer bars than trades, so the trades say which symbols are large.
    return wall_time(joins.as_of(trades, provided, probe=trades.select("symbol")))


def g18_as_of_bar_stream(spark, sf_dir):
    """The trade stream with the last bar of the running bar stream, in keyed state."""
    trades, provided = _running(spark, sf_dir)
    with stream_joins.keyed_state(spark):
        rows = stream_joins.as_of(
            trades.select("id", "symbol", "datetime", "last_price"), provided, "1 hour", slot="6 hours", salts=4)
        found = _streamed(spark, rows, "append")
    return wall_time(found.drop("query_id", "batch_id"))


def g19_trades_to_bar(spark, sf_dir):
    trades = _trades(spark, sf_dir, "event_type").select("id", "symbol", "datetime", "last_price")
    return wall_time(joins.to_bar(trades, _provided(spark, sf_dir), "1 hour"))


def g19_trades_to_shifted_bar(spark, sf_dir):
    """Bars that start half past the hour, as from an exchange's opening."""
    trades = _trades(spark, sf_dir, "event_type").select("id", "symbol", "datetime", "last_price")
    half = F.expr("INTERVAL 30 MINUTES")
    early = _trades(spark, sf_dir, "event_type").withColumn("datetime", F.col("datetime") - half)
    shifted = bars.ohlcv(early, "1 hour").withColumn("datetime", F.col("datetime") + half)
    return wall_time(joins.to_bar(trades, shifted, "1 hour"))


def g19_trades_to_any_bar(spark, sf_dir):
    """Bars from five minutes to a day, and off the hour, in one join."""
    trades = _trades(spark, sf_dir, "event_type").select("id", "symbol", "datetime", "last_price")
    source = _trades(spark, sf_dir, "event_type")
    table = None
    for width, shift in (("5 minutes", 0), ("1 hour", 30), ("4 hours", 0), ("1 day", 0)):
        moved = F.make_dt_interval(mins=F.lit(shift))
        part = bars.ohlcv(source.withColumn("datetime", F.col("datetime") - moved), width)
        part = part.withColumn("datetime", F.col("datetime") + moved).withColumn(
            "bar_end", F.col("datetime") + F.expr(f"INTERVAL {width}"))
        table = part if table is None else table.unionByName(part)
    return wall_time(joins.to_any_bar(trades, table, "1 minute"))


def g19_trades_to_bar_stream(spark, sf_dir):
    """The trade stream joined to the stream of stored bar messages."""
    topic = scratch_path(spark, "topic")
    inputs.bar_messages(inputs.events(spark, sf_dir)).write.parquet(topic)
    bar_rows = table_rows(FileTopics(topic).read_stream(spark, BARS.topic), BARS).withColumnRenamed(
        "ticker", "symbol")
    trades = inputs.trades(inputs.event_stream(spark, sf_dir), "event_type").select(
        "id", "symbol", "datetime", "last_price")
    rows = windows.to_bar(trades, bar_rows, "1 hour", "2 hours")
    return wall_time(_streamed(spark, rows, "append").drop("query_id", "batch_id"))


def g20_reconcile_bars(spark, sf_dir):
    rows = joins.reconcile(_hourly(spark, sf_dir, "event_type"), _provided(spark, sf_dir))
    return wall_time(rows.select(
        "symbol", "datetime", "missing",
        *[F.round(f"{v}_diff", 4).alias(f"{v}_diff") for v in ("open", "high", "low", "close")],
        "volume_diff"))


def g20_reconcile_bars_stream(spark, sf_dir):
    """Own hourly bars beside the provider's while both run; lone ones once their hour has closed."""
    trades, provided = _running(spark, sf_dir)
    rows = stream_joins.reconcile(trades, provided, "1 hour", "1 hour")
    found = _streamed(spark, rows, "append").drop("query_id", "batch_id")
    return wall_time(found.withColumns({
        f"{v}_diff": F.round(f"{v}_diff", 4) for v in ("open", "high", "low", "close")}))


def g21_valuation(spark, sf_dir):
    """Holdings from fills, valued at the last trade of the symbol."""
    fills = inputs.fills(spark, sf_dir)
    held = joins.positions(inputs.orders(spark, sf_dir), fills)
    quotes = ranking.latest(_trades(spark, sf_dir), "symbol").select(
        "symbol", F.col("last_price").alias("price"))
    return joins.valuation(held, quotes).withColumn("value", F.round("value", 4))


def _sided(spark, sf_dir):
    """Fills at whole cents of which even lines are sales, and which side each is on."""
    fills = inputs.fills(spark, sf_dir).withColumn("last_price", F.round(F.col("last_price") * F.col("quantity"), 2))
    return fills, F.col("line") % 2 == 1


def g21_lots(spark, sf_dir):
    """Sales matched to the earliest open buys of their symbol."""
    fills, bought = _sided(spark, sf_dir)
    matched = lots.fifo(fills, ["symbol"], bought, order=LOT_ORDER, quantity="quantity")
    return wall_time(matched.withColumns({c: F.round(c, 4) for c in ("buy_price", "sale_price", "gain")}))


def g21_gains(spark, sf_dir):
    """Realised and open gain per symbol, open lots at the symbol's last fill."""
    fills, bought = _sided(spark, sf_dir)
    how = {"order": LOT_ORDER, "quantity": "quantity"}
    place = F.struct(*LOT_ORDER)
    quotes = fills.groupBy("symbol").agg(F.max_by("last_price", place).alias("price"))
    how["intervals"] = lots.counted(fills, ["symbol"], bought, **how)
    rows = lots.gains(
        lots.fifo(fills, ["symbol"], bought, **how), lots.open_lots(fills, ["symbol"], bought, **how), quotes, ["symbol"])
    return rows.withColumns({c: F.round(c, 3) for c in ("realised", "cost", "open_gain")})


LOT_ORDER = ("datetime", "order_id", "line")


def g22_adjusted_closes(spark, sf_dir):
    rows = series.adjust(inputs.daily_bars(spark, sf_dir), "symbol", hot_rows=BOUNDED)
    return wall_time(rows.select(
        "symbol", "datetime",
        *[F.col(c).cast("float").alias(c) for c in ("adjustment", "adjusted_close", "total_return")],
    ))


def g23_gaps(spark, sf_dir):
    closes = _closes(spark, sf_dir)
    return wall_time(series.gaps(closes, "symbol", 3600, hot_rows=BOUNDED))


def g23_filled_bars(spark, sf_dir):
    closes = _closes(spark, sf_dir)
    return wall_time(series.fill(closes, "symbol", 3600, hot_rows=BOUNDED))


def _universe(spark, sf_dir):
    return inputs.table(spark, sf_dir, "part").select(F.col("p_partkey").cast("string").alias("symbol"))


def g24_never_traded(spark, sf_dir):
    return joins.never_traded(_universe(spark, sf_dir), _trades(spark, sf_dir))


def g24_traded(spark, sf_dir):
    return joins.traded(_universe(spark, sf_dir), _trades(spark, sf_dir))


def g24_both_sources(spark, sf_dir):
    return joins.in_both(_trades(spark, sf_dir), inputs.fills(spark, sf_dir))


def g24_both_sources_sketch(spark, sf_dir):
    """Symbols of trades, of fills and of both, from sketches of each side's days."""
    store = _kept_up(spark, sf_dir, lambda path: partials.daily_symbols(path, 16))
    filled = inputs.fills(spark, sf_dir).groupBy(F.to_date("datetime").alias("day")).agg(
        F.theta_sketch_agg("symbol", 16).alias("symbols"))
    return partials.symbols_in_both(store.rows(spark), filled, 16)


def g24_surplus_rows(spark, sf_dir):
    """Symbol and day of trades that the purchases do not account for."""
    days = _trades(spark, sf_dir).select("symbol", F.to_date("datetime").alias("day"), "trade_conditions")
    bought = reports.with_condition(days, "purchase")
    return joins.surplus(days.select("symbol", "day"), bought.select("symbol", "day"))


def g25_trade_quality(spark, sf_dir):
    return reports.trade_quality(table_rows(inputs.flawed_messages(inputs.events(spark, sf_dir)), TRADES))


def g25_quality_in_flight(spark, sf_dir):
    """Quality counts of each micro-batch, observed while its rows are written."""
    messages = inputs.flawed_messages(inputs.events(spark, sf_dir))
    topic = scratch_path(spark, "topic")
    for part in range(3):
        messages.where(F.col("offset") % 3 == part).coalesce(1).write.mode("append").parquet(topic)
    stream = FileTopics(topic, max_files_per_trigger=1).read_stream(spark, TRADES.topic)
    counts = sinks.BatchDirectory(scratch_path(spark, "quality"))
    run(ingest(stream, TRADES, sinks.BatchDirectory(scratch_path(spark, "trades")), scratch_path(spark, "offsets"),
               quality=counts))
    return spark.read.parquet(counts.path).drop("query_id")


def g25_flawed_bars(spark, sf_dir):
    """Bars whose high, low, open or volume some hours break."""
    hour = F.hour("datetime")
    flawed = _hourly(spark, sf_dir).withColumns({
        "high": F.when(hour % 5 == 0, F.col("low") - 1).otherwise(F.col("high")),
        "open": F.when(hour % 7 == 0, F.col("high") + 1).otherwise(F.col("open")),
        "volume": F.when(hour % 3 == 0, 0).otherwise(F.col("volume")),
        "symbol": F.when(hour == 11, F.lit(None)).otherwise(F.col("symbol"))})
    return reports.bar_quality(flawed)


def g25_bar_quality(spark, sf_dir):
    return reports.bar_quality(_hourly(spark, sf_dir))


def g26_percentiles(spark, sf_dir):
    trades = _trades(spark, sf_dir, "event_type").select("symbol", "last_price")
    return reports.percentiles(trades, "symbol", "last_price", (1, 25, 50, 95, 99))


def g26_approx_percentiles(spark, sf_dir):
    """Symbols, and whether every estimate is within a twentieth of the exact value."""
    trades = _trades(spark, sf_dir, "event_type").select("symbol", "last_price")
    percents = (1, 25, 50, 95, 99)
    exact = reports.percentiles(trades, "symbol", "last_price", percents)
    exact = exact.withColumnsRenamed({f"p{p}": f"e{p}" for p in percents})
    both = reports.approx_percentiles(trades, "symbol", "last_price", percents).join(exact, "symbol")
    near = [F.abs(F.col(f"p{p}") - F.col(f"e{p}")) <= F.greatest(F.lit(1.0), 0.05 * F.col(f"e{p}")) for p in percents]
    return both.select("symbol", reduce(lambda x, y: x & y, near).alias("close"))


def g26_range_percentiles(spark, sf_dir):
    """Prices of a range of days from daily sketches: their number, and whether ranks are within one percent."""
    first, last, percents = "2024-01-02", "2024-01-25", (1, 25, 50, 95, 99)
    kind = F.col("trade_conditions")[0]
    store = _kept_up(spark, sf_dir, lambda path: partials.daily_prices(path, kind))
    found = partials.price_percentiles(store, spark, first, last, percents)
    trades = _trades(spark, sf_dir, "event_type").where(F.to_date("datetime").between(first, last))
    price = F.col("last_price").cast("float").cast("double")
    ranks = trades.join(found, "symbol").groupBy("symbol", "n").agg(*[
        F.struct((F.count_if(price < F.col(f"p{p}")) / F.count(F.lit(1))).alias("below"),
                 (F.count_if(price <= F.col(f"p{p}")) / F.count(F.lit(1))).alias("upto")).alias(f"r{p}")
        for p in percents])
    near = [(F.col(f"r{p}.below") <= p / 100 + 0.01) & (F.col(f"r{p}.upto") >= p / 100 - 0.01) for p in percents]
    return ranks.select("symbol", "n", reduce(lambda x, y: x & y, near).alias("close"))


def g26_outliers(spark, sf_dir):
    trades = _trades(spark, sf_dir, "event_type").select("id", "symbol", "last_price")
    rows = reports.outliers(trades, "symbol", "last_price", 2.5)
    return rows.withColumn("zscore", F.round("zscore", 6))


def g26_outliers_scaled(spark, sf_dir):
    """The same on prices a millionth as large."""
    trades = _trades(spark, sf_dir, "event_type").select(
        "id", "symbol", (F.col("last_price") * 1e-6).alias("last_price"))
    rows = reports.outliers(trades, "symbol", "last_price", 2.5)
    return rows.select("id", "symbol", F.round("zscore", 6).alias("zscore"))


QUERIES = {name: query for name, query in list(globals().items()) if name[:1] == "g" and name[1:3].isdigit()}
