"""Changes between snapshots, found bucket by bucket, against a comparison row by row."""

import json

import pytest

from casemill.operators.keyed import change_log


@pytest.mark.parametrize("buckets", [1, 7, 1 << 16])
def test_change_log(spark, buckets):
    schema = "id int, part string, v string"
    old = [(k, "a" if k % 2 else None, str(k)) for k in range(60)]
    new = [(k, p, v if k % 9 else v + "!") for k, p, v in old if k % 10] + [(100, "b", None)]
    got = change_log(spark.createDataFrame(old, schema), spark.createDataFrame(new, "id int, part string, v string").select("v", "part", "id"), ["id"], buckets)
    told = {(r.op, r.id): (r.old_json and json.loads(r.old_json).get("v"), r.new_json and json.loads(r.new_json).get("v")) for r in got.collect()}
    want = {("DELETE", k): (str(k), None) for k in range(0, 60, 10)} | {("UPDATE", k): (str(k), f"{k}!") for k in range(0, 60, 9) if k % 10} | {("INSERT", 100): (None, None)}
    assert told == want
    same = spark.createDataFrame(old, schema)
    assert change_log(same, same, ["id"], buckets).count() == 0
    assert change_log(same.limit(0), same, ["id"], buckets).count() == 60
