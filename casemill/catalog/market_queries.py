"""Trades, candles and prices."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F

from ..plans import market
from .registry import query, stage

stage("st_candles", """
SELECT symbol, date_trunc('minute', event_time) AS minute, arg_min(price, (event_time, trade_id)) AS open_price, max(price) AS high_price,
  min(price) AS low_price, arg_max(price, (event_time, trade_id)) AS close_price, round(sum(quantity), 6) AS volume, count(trade_id) AS trade_count
FROM fx_trades GROUP BY symbol, date_trunc('minute', event_time)""")


def _round(df, *columns):
    return df.withColumns({c: F.round(c, 6) for c in columns})


def _candles(d):
    return _round(market.ohlcv_1min(d.fx_trades), "volume")


query("ohlcv_1min", "SELECT * FROM st_candles")(_candles)


@query("daily_stats", """
SELECT symbol, CAST(minute AS DATE) AS date, arg_min(open_price, minute) AS open_price, max(high_price) AS high_price, min(low_price) AS low_price,
  arg_max(close_price, minute) AS close_price, round(sum(volume), 6) AS volume,
  round((max(high_price) - min(low_price)) / nullif(arg_min(open_price, minute), 0) * 100, 6) AS volatility_pct
FROM st_candles GROUP BY symbol, CAST(minute AS DATE)""")
def daily_stats(d):
    return _round(market.daily_stats(_candles(d)), "volume", "volatility_pct")


@query("price_changes", """
SELECT symbol, minute, close_price, prev_close, round((close_price - prev_close) / nullif(prev_close, 0) * 100, 2) AS pct_change
FROM (SELECT *, lag(close_price) OVER (PARTITION BY symbol ORDER BY minute) AS prev_close FROM st_candles) q WHERE prev_close IS NOT NULL""")
def price_changes(d):
    return market.price_changes(_candles(d))


@query("candle_spread", """
SELECT symbol, minute, open_price, high_price, low_price, close_price, high_price - low_price AS spread FROM st_candles
WHERE symbol = 'BTCUSDT' AND minute >= TIMESTAMP '2024-01-01 00:00:00'""")
def candle_spread(d):
    return market.candle_spread(_candles(d), "BTCUSDT", dt.datetime(2024, 1, 1))


@query("volume_by_symbol", """
SELECT symbol, count(*) AS trade_count, round(sum(quantity), 6) AS total_volume, min(price) AS min_price, max(price) AS max_price,
  round(avg(price), 6) AS avg_price, min(event_time) AS first_trade, max(event_time) AS last_trade FROM fx_trades GROUP BY symbol""")
def volume_by_symbol(d):
    return _round(market.volume_by_symbol(d.fx_trades), "total_volume", "avg_price")


@query("trade_velocity", """
SELECT symbol, date_trunc('minute', event_time) AS minute, count(*) AS trades_per_minute, round(sum(quantity), 6) AS volume_per_minute,
  round(avg(price), 6) AS avg_price FROM fx_trades GROUP BY symbol, date_trunc('minute', event_time)""")
def trade_velocity(d):
    return _round(market.trade_velocity(d.fx_trades), "volume_per_minute", "avg_price")


@query("latest_prices", """
SELECT symbol, price AS latest_price, quantity, event_time FROM fx_trades
QUALIFY row_number() OVER (PARTITION BY symbol ORDER BY event_time DESC, trade_id DESC) = 1""")
def latest_prices(d):
    return market.latest_prices(d.fx_trades)


@query("ohlcv_recent", "SELECT * FROM st_candles WHERE symbol = 'ETHUSDT' ORDER BY minute DESC LIMIT 100")
def ohlcv_recent(d):
    return market.ohlcv_recent(_candles(d), "ETHUSDT", 100)
