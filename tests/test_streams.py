"""Streams count every trade and record once, whatever is delivered or replayed again."""

import datetime as dt
import json

from casemill.streaming import jobs

TRADE = {"symbol": "A", "price": 1.5, "quantity": 2.0, "event_time": "2024-01-01T00:00:10", "trade_id": 1, "is_buyer_maker": True, "ingested_at": "2024-01-01T00:00:11"}


def deliver(folder, name, *trades):
    folder.mkdir(exist_ok=True)
    (folder / name).write_text("\n".join(json.dumps(TRADE | t) for t in trades))


def test_trades_delivered_again_with_another_time(spark, tmp_path):
    for within in (None, "1 day"):
        root = tmp_path / str(within).replace(" ", "")
        root.mkdir()
        go = lambda: jobs.stream_trades_bronze(spark, str(root / "in"), str(root / "t"), str(root / "c"), within=within)  # noqa: B023, E731
        deliver(root / "in", "1.txt", {}, {"trade_id": 2}, {"symbol": "B"}, {"trade_id": 2, "event_time": "2024-01-01T00:03:00"})
        go()
        deliver(root / "in", "2.txt", {"event_time": "2024-01-01T05:00:00"}, {"trade_id": 3}, {"trade_id": None})
        go()
        go()
        rows = [(r.symbol, r.trade_id) for r in spark.read.parquet(str(root / "t")).collect()]
        assert sorted(rows) == [("A", 1), ("A", 2), ("A", 3), ("B", 1)]
        assert spark.read.parquet(str(root / "t_rejects")).count() == 1
        assert spark.conf.get("spark.sql.streaming.stateStore.providerClass") != jobs.STATE["spark.sql.streaming.stateStore.providerClass"]


def test_candles_of_replayed_batches(spark, tmp_path):
    root, at = tmp_path, lambda s: {"event_time": f"2024-01-01T00:00:{s:02}"}
    names = [str(root / n) for n in ("t", "candles")]
    bronze = lambda: jobs.stream_trades_bronze(spark, str(root / "in"), names[0], str(root / "ct"))
    candles = lambda check="cc": jobs.stream_candles(spark, *names, str(root / check))
    deliver(root / "in", "1.txt", {"price": 5.0, **at(10)}, {"trade_id": 2, "price": 9.0, **at(20)})
    bronze()
    candles()
    deliver(root / "in", "2.txt", {"trade_id": 3, "price": 7.0, **at(5)}, {"trade_id": 4, "event_time": "2024-01-02T00:00:00"})  # one is late, in a minute already written
    bronze()
    candles()

    def told():
        return sorted((r.symbol, str(r.minute), r.open_price, r.high_price, r.close_price, r.volume, r.trade_count) for r in jobs.read_candles(spark, names[1]).collect())

    want = [("A", "2024-01-01 00:00:00", 7.0, 9.0, 9.0, 6.0, 3), ("A", "2024-01-02 00:00:00", 1.5, 1.5, 1.5, 2.0, 1)]
    assert told() == want
    for batch in (0, 1):  # each batch of trades is written again, twice
        for k in range(2):
            again = str(root / f"again-{batch}-{k}")
            spark.read.schema(jobs.TRADE_TABLE).parquet(names[0]).where(f"batch = {batch}").drop("batch").write.parquet(again)
            jobs.write_batch(spark.read.parquet(again), names[0], batch, ("event_date",))
            candles()
            assert told() == want
    deliver(root / "in", "3.txt", {"trade_id": 5, "price": 1.0, **at(50)})
    bronze()
    candles("lost")  # a new checkpoint goes over all trades, behind the versions there are
    assert told()[0] == ("A", "2024-01-01 00:00:00", 7.0, 9.0, 1.0, 8.0, 4)
    candles("lost")
    candles()
    assert told()[0][-1] == 4


def test_kinds_of_raw_rows(spark, tmp_path):
    landed, sink = str(tmp_path / "landed"), str(tmp_path / "canonical")
    call = {"caller": "0612345678", "callee": "0687654321", "call_date": "2024-01-01", "call_time": "10:00:00", "duration_seconds": "5", "call_type": "incoming"}
    calls = lambda *rows: spark.createDataFrame([(i, "OND-1", "S", c["caller"], c["callee"], c["call_date"], c["call_time"], c["duration_seconds"], c["call_type"], json.dumps(c)) for i, c in rows], jobs.RAW["call"])
    message = spark.createDataFrame([("m", "OND-1", "S", "0612345678", "0687654321", "hello", "sms", json.dumps({"sender": "0612345678", "recipient": "0687654321", "timestamp": "1704103200000", "message_text": "hello"}))], jobs.RAW["message"])
    go = lambda: jobs.stream_canonical(spark, landed, sink, str(tmp_path / "check"), dt.datetime(2025, 1, 1))
    jobs.land_raw(calls(("a", call), ("b", call | {"callee": ""})), "call", landed)
    jobs.land_raw(message, "message", landed)
    go()
    status = lambda kind: {r.source_record_id: r.validation_status for r in jobs.read_canonical(spark, sink, kind).collect()}
    first = status("call")
    assert set(first) == {"a", "b"} and first["b"] == "error" and set(status("message")) == {"m"}
    jobs.land_raw(calls(("b", call)), "call", landed)  # mended later
    go()
    go()
    assert status("call") == {"a": first["a"], "b": first["a"]} and set(status("message")) == {"m"}
