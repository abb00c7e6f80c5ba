"""Streams worked off over the given tables, with batches delivered and replayed more than once."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..plans.market import TRADE_COLUMNS
from ..session import scratch
from ..streaming import jobs
from . import layers as L
from .model_queries import COMM_COLUMNS, TX_COLUMNS
from .registry import query


def _deliver(trades, folder: str) -> None:
    trades.select(F.to_json(F.struct(*TRADE_COLUMNS)).alias("value")).write.mode("append").text(folder)


def _streamed_trades(d, root: str) -> None:
    """All trades delivered once, then every third one again with another time."""
    _deliver(d.fx_trades, f"{root}/topic")
    jobs.stream_trades_bronze(d.spark, f"{root}/topic", f"{root}/bronze", f"{root}/check-bronze")
    later = d.fx_trades.withColumn("event_time", F.col("event_time") + F.expr("INTERVAL 90 SECONDS"))
    _deliver(later.where("trade_id % 3 = 0"), f"{root}/topic")
    jobs.stream_trades_bronze(d.spark, f"{root}/topic", f"{root}/bronze", f"{root}/check-bronze")


@query("streamed_trades", "SELECT symbol, trade_id, price, quantity, event_time FROM fx_trades")
def streamed_trades(d):
    root = scratch(d.spark, "streamed-trades")
    _streamed_trades(d, root)
    return d.spark.read.parquet(f"{root}/bronze").select("symbol", "trade_id", "price", "quantity", "event_time")


@query("streamed_candles", "SELECT * FROM st_candles")
def streamed_candles(d):
    """Two replays: the first batch of the trade table is written again, then the checkpoint of the candles is new."""
    root = scratch(d.spark, "streamed-candles")
    _streamed_trades(d, root)
    candles = lambda check: jobs.stream_candles(d.spark, f"{root}/bronze", f"{root}/candles", f"{root}/{check}")
    candles("check-candles")
    again = d.spark.read.schema(jobs.TRADE_TABLE).parquet(f"{root}/bronze").where(F.col(jobs.BATCH) == 0).drop(jobs.BATCH)
    jobs.write_batch(_kept(d, again, f"{root}/again"), f"{root}/bronze", 0, ("event_date",))
    candles("check-candles")
    candles("check-anew")
    return jobs.read_candles(d.spark, f"{root}/candles").withColumn("volume", F.round("volume", 6))


def _kept(d, df, path: str):
    df.write.parquet(path)
    return d.spark.read.parquet(path)


def _streamed_canonical(d, name: str) -> str:
    """Each kind landed in two parts, and a part of the first one again."""
    root = scratch(d.spark, name)
    stream = lambda: jobs.stream_canonical(d.spark, f"{root}/landed", f"{root}/canonical", f"{root}/check", L.AS_OF)
    kinds = {"transaction": L.raw_tx(d), "call": L.raw_calls(d), "message": L.raw_messages(d)}
    for odd in (0, 1):
        for kind, raw in kinds.items():
            jobs.land_raw(raw.where(F.pmod(F.xxhash64(f"{kind}_id"), F.lit(2)) == odd), kind, f"{root}/landed")
        stream()
    for kind, raw in kinds.items():
        jobs.land_raw(raw.where(F.pmod(F.xxhash64(f"{kind}_id"), F.lit(4)) == 0), kind, f"{root}/landed")
    stream()
    return f"{root}/canonical"


@query("streamed_transactions", f"SELECT {TX_COLUMNS} FROM st_canon_tx")
def streamed_transactions(d):
    return jobs.read_canonical(d.spark, _streamed_canonical(d, "streamed-transactions"), "transaction").drop("source_file_name", "transaction_reference", "source_raw_data")


@query("streamed_communications", f"SELECT {COMM_COLUMNS} FROM st_canon_comm")
def streamed_communications(d):
    sink = _streamed_canonical(d, "streamed-communications")
    both = [jobs.read_canonical(d.spark, sink, kind) for kind in ("call", "message")]
    return both[0].unionByName(both[1]).drop("source_file_name", "source_raw_data")
