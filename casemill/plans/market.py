"""Trades, candles and prices."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, functions as F

from ..operators.keyed import newest_per_key, previous_value, upsert_latest

TRADE_JSON = "map<string, string>"  # field names that differ by case alone are no struct
TRADE_COLUMNS = {"symbol": "string", "price": "double", "quantity": "double", "event_time": "timestamp_ntz",
                 "trade_id": "bigint", "is_buyer_maker": "boolean", "ingested_at": "timestamp_ntz"}


def reshape_trade_events(events: DataFrame, received: Column) -> DataFrame:
    """Exchange events with short keys (column ``value``) to trade rows."""
    e = F.col("e")
    return events.withColumn("e", F.from_json("value", TRADE_JSON)).select(
        e["s"].alias("symbol"), e["p"].try_cast("double").alias("price"), e["q"].try_cast("double").alias("quantity"),
        F.timestamp_millis(e["T"].try_cast("bigint")).cast("timestamp_ntz").alias("event_time"),
        e["t"].try_cast("bigint").alias("trade_id"), e["m"].try_cast("boolean").alias("is_buyer_maker"),
        received.cast("timestamp_ntz").alias("ingested_at"))


def parse_trades(messages: DataFrame, keep: list[str] | None = None) -> DataFrame:
    """Topic messages (JSON text in ``value``) to typed trades; times are ISO text. Columns ``keep`` of the messages stay."""
    text = {"timestamp_ntz": "string"}
    schema = ", ".join(f"{c} {text.get(t, t)}" for c, t in TRADE_COLUMNS.items())
    parsed = messages.select(F.from_json("value", schema).alias("e"), *(keep or []))
    return parsed.select(*(keep or []), *[F.col(f"e.{c}").try_cast(t).alias(c) for c, t in TRADE_COLUMNS.items()])


def _typed(trades: DataFrame, keep: list[str] | None = None) -> DataFrame:
    return trades.select(*(keep or []), *[F.col(c).cast(t).alias(c) for c, t in TRADE_COLUMNS.items()])


def complete_trades(trades: DataFrame) -> DataFrame:
    """Typed rows with every field filled, as the trade table demands; ``incomplete_trades`` has all others."""
    return _typed(trades).na.drop(subset=list(TRADE_COLUMNS))


def incomplete_trades(trades: DataFrame, keep: list[str] | None = None) -> DataFrame:
    """The rows that ``complete_trades`` leaves out, with the names of the fields that are null or NaN."""
    absent = F.concat_ws(",", *[F.when(F.col(c).isNull() | (F.isnan(c) if t == "double" else F.lit(False)), F.lit(c)) for c, t in TRADE_COLUMNS.items()])
    return _typed(trades, keep).withColumn("missing", absent).where("missing <> ''")


def _order() -> Column:
    return F.struct("event_time", "trade_id")


def candle_parts(trades: DataFrame) -> DataFrame:
    """Per symbol and minute what is needed to build or later extend a candle."""
    return trades.groupBy("symbol", F.date_trunc("minute", "event_time").alias("minute")).agg(
        F.min(F.struct("event_time", "trade_id", "price")).alias("first"),
        F.max("price").alias("high_price"), F.min("price").alias("low_price"),
        F.max(F.struct("event_time", "trade_id", "price")).alias("last"),
        F.sum("quantity").alias("volume"), F.count("trade_id").alias("trade_count"))


def merge_parts(parts: DataFrame) -> DataFrame:
    """Candles from parts that may cover the same minute more than once."""
    merged = parts.groupBy("symbol", "minute").agg(
        F.min("first").alias("first"), F.max("high_price").alias("high_price"),
        F.min("low_price").alias("low_price"), F.max("last").alias("last"),
        F.sum("volume").alias("volume"), F.sum("trade_count").alias("trade_count"))
    return _candles(merged)


def _candles(parts: DataFrame) -> DataFrame:
    return parts.select("symbol", F.col("minute").cast("timestamp_ntz").alias("minute"),
                        F.col("first.price").alias("open_price"), "high_price", "low_price",
                        F.col("last.price").alias("close_price"), "volume", "trade_count")


def ohlcv_1min(trades: DataFrame, as_of: dt.datetime | None = None, hours: int = 1) -> DataFrame:
    """One-minute candles, of all trades or of the last hours before ``as_of``."""
    if as_of is not None:
        since = as_of - dt.timedelta(hours=hours)
        trades = trades.where(F.col("event_time") >= F.lit(since).cast("timestamp_ntz"))
    return _candles(candle_parts(trades))


def daily_stats(candles: DataFrame) -> DataFrame:
    day = F.to_date("minute")
    rolled = candles.groupBy("symbol", day.alias("date")).agg(
        F.min_by("open_price", "minute").alias("open_price"), F.max("high_price").alias("high_price"),
        F.min("low_price").alias("low_price"), F.max_by("close_price", "minute").alias("close_price"),
        F.sum("volume").alias("volume"))
    swing = (F.col("high_price") - F.col("low_price")) / F.nullif(F.col("open_price"), F.lit(0.0)) * 100
    return rolled.withColumn("volatility_pct", swing)


def price_changes(candles: DataFrame, bucket: str = "day") -> DataFrame:
    """Change of the close against the candle before, in percent; the first candle has none."""
    stepped = previous_value(candles.select("symbol", "minute", "close_price"), "symbol", "minute", "close_price",
                             "prev_close", bucket)
    change = F.round((F.col("close_price") - F.col("prev_close")) / F.nullif(F.col("prev_close"), F.lit(0.0)) * 100, 2)
    return stepped.where("prev_close IS NOT NULL").select(
        "symbol", "minute", "close_price", "prev_close", change.alias("pct_change"))


def candle_spread(candles: DataFrame, symbol: str, since: dt.datetime) -> DataFrame:
    recent = candles.where((F.col("symbol") == symbol) & (F.col("minute") >= F.lit(since).cast("timestamp_ntz")))
    return recent.select("symbol", "minute", "open_price", "high_price", "low_price", "close_price",
                         (F.col("high_price") - F.col("low_price")).alias("spread"))


def volume_by_symbol(trades: DataFrame) -> DataFrame:
    return trades.groupBy("symbol").agg(
        F.count("*").alias("trade_count"), F.sum("quantity").alias("total_volume"), F.min("price").alias("min_price"),
        F.max("price").alias("max_price"), F.avg("price").alias("avg_price"),
        F.min("event_time").alias("first_trade"), F.max("event_time").alias("last_trade"))


def trade_velocity(trades: DataFrame) -> DataFrame:
    minute = F.date_trunc("minute", "event_time").cast("timestamp_ntz")
    return trades.groupBy("symbol", minute.alias("minute")).agg(
        F.count("*").alias("trades_per_minute"), F.sum("quantity").alias("volume_per_minute"),
        F.avg("price").alias("avg_price"))


def latest_prices(trades: DataFrame) -> DataFrame:
    last = newest_per_key(trades.select("symbol", "event_time", "trade_id", "price", "quantity"),
                          ["symbol"], ["event_time", "trade_id"])
    return last.select("symbol", F.col("price").alias("latest_price"), "quantity", "event_time")


def ohlcv_recent(candles: DataFrame, symbol: str | None = None, limit: int = 100) -> DataFrame:
    rows = candles if symbol is None else candles.where(F.col("symbol") == symbol)
    return rows.orderBy(F.desc("minute"), "symbol").limit(limit)


def refresh_candles(old: DataFrame, new: DataFrame) -> DataFrame:
    """Recomputed candles replace those of the same symbol and minute."""
    return upsert_latest(old, new, ["symbol", "minute"], ["trade_count"])
