"""Intake reads whole writes and whole heads, and sets incomplete trades aside."""

import inspect
import json

from casemill.operators.intake import JSON_HEAD, detect_file_types
from casemill.sources.readers import scan_latest_file, topic_stream
from casemill.streaming.jobs import stream_trades_bronze


def test_latest_write_is_read_whole(spark, tmp_path):
    folder = str(tmp_path / "w")
    spark.range(5).write.parquet(folder)
    spark.range(100, 140, numPartitions=4).write.mode("append").parquet(folder)
    assert sorted(r.id for r in scan_latest_file(spark, folder).collect()) == list(range(100, 140))


def test_json_keywords_anywhere_in_the_head(spark):
    head = json.dumps({"filler": "x" * 2000, "posts": [], "friends": []})
    files = spark.createDataFrame([("a.json", head)], "file_name string, head string")
    assert detect_file_types(files).first().file_type == "social_media"
    assert detect_file_types(files, JSON_HEAD).first().file_type == "unknown"


def test_incomplete_trades_are_set_aside(spark, tmp_path):
    whole = {"symbol": "A", "price": 1.5, "quantity": 2, "event_time": "2024-01-01T00:00:00", "trade_id": 1, "is_buyer_maker": True, "ingested_at": "2024-01-01T00:00:01"}
    lines = [json.dumps(whole), json.dumps(whole | {"trade_id": 2, "price": None}), "no json"]
    (tmp_path / "in").mkdir()
    (tmp_path / "in" / "a.txt").write_text("\n".join(lines))
    sink = str(tmp_path / "trades")
    stream_trades_bronze(spark, str(tmp_path / "in"), sink, str(tmp_path / "check"))
    assert [r.trade_id for r in spark.read.parquet(sink).collect()] == [1]
    rejects = {r.value: r.missing for r in spark.read.parquet(f"{sink}_rejects").collect()}
    assert rejects == {lines[1]: "price", lines[2]: ",".join(whole)}


def test_topic_start_must_be_told():
    told = inspect.signature(topic_stream).parameters
    assert told["starting"].default is told["per_trigger"].default is inspect.Parameter.empty
