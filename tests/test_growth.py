"""Files, memory and passes that must not outgrow the input."""

import datetime as dt

from pyspark.sql import functions as F

from casemill import catalog
from casemill.functions import dates, text
from casemill.operators import keyed
from casemill.plans import models
from casemill.streaming import jobs


def test_a_date_gets_one_file_and_a_busy_one_more(spark, tmp_path, monkeypatch):
    rows = spark.range(0, 4000, 1, 16).select("id", F.when(F.col("id") < 3000, "busy").when(F.col("id") < 3900, "calm").alias("event_date"))
    jobs.write_batch(rows, str(tmp_path / "one"), 0, ("event_date",))
    names = lambda folder: sorted(p.parent.parent.name for p in (tmp_path / folder).glob("*/*/*.parquet"))
    assert names("one") == ["event_date=__HIVE_DEFAULT_PARTITION__", "event_date=busy", "event_date=calm"]
    monkeypatch.setattr(jobs, "ROWS_PER_FILE", 1000)
    merging = "spark.sql.adaptive.coalescePartitions.enabled"
    before = spark.conf.get(merging)
    spark.conf.set(merging, "false")
    try:
        jobs.write_batch(rows, str(tmp_path / "more"), 0, ("event_date",))
    finally:
        spark.conf.set(merging, before)
    assert names("more").count("event_date=calm") == 1 and 1 < names("more").count("event_date=busy") <= 3
    for folder in ("one", "more"):
        back = spark.read.parquet(str(tmp_path / folder)).select("id", "event_date")
        assert sorted(map(tuple, back.collect()), key=str) == sorted(map(tuple, rows.collect()), key=str)


def _plan(df):
    return df._jdf.queryExecution().optimizedPlan().toString(), df._jdf.queryExecution().executedPlan().toString()


def test_numbers_go_on_without_the_rows_meeting_the_known_groups(spark):
    day = F.col("d")
    rows = spark.createDataFrame([("a", 1, 1), ("a", 1, 2), ("a", 2, 1), ("b", 1, 1), (None, 1, 1), (None, 2, 1)], "g string, d int, k int")
    known = spark.createDataFrame([("a", 7), ("c", 100)], "g string, highest bigint")
    out = keyed.new_ids(rows, known, "g", ["d", "k"], day)
    want = {("a", 1, 1, 8), ("a", 1, 2, 9), ("a", 2, 1, 10), ("b", 1, 1, 1), (None, 1, 1, 1), (None, 2, 1, 2)}
    assert {(r.g, r.d, r.k, r.number) for r in out.collect()} == want
    top = next(line for line in _plan(out)[0].splitlines() if "Join" in line)
    assert "_bucket" in top and "shuffle_hash" in top  # the last join is by group and bucket, the counts on the held side


def _tables(spark, folder):
    spark.createDataFrame([(k, f"C{k}") for k in range(6)], "c_custkey bigint, c_name string").write.parquet(f"{folder}/customer.parquet")
    spark.createDataFrame([(k, k % 6, "F", 10.0 * k, dt.date(1995 + k % 7, 1, 1 + k % 28)) for k in range(60)],
                          "o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_totalprice double, o_orderdate date").write.parquet(f"{folder}/orders.parquet")
    return str(folder)


def test_rows_that_are_read_twice_are_mapped_once(spark, tmp_path):
    folder = _tables(spark, tmp_path)
    for name in ("upsert_partial", "fact_transaction", "fact_transaction_masked"):
        out = catalog.QUERIES[name](spark, folder)
        assert "from_json" not in _plan(out)[0], name
        assert out.count() > 0


def test_upserts_carry_each_column_once(spark):
    rows = spark.createDataFrame([("a", 1, "x", None), ("a", 2, "y", 5), ("b", 3, None, 6), ("b", 3, "z", 1)], "k string, at int, s string, n int")
    out = keyed.upsert_partial(rows.where("at = 1"), rows.where("at > 1"), ["k"], ["n"], ["at"])
    assert sorted(map(tuple, out.collect())) == [("a", 1, "x", 5), ("b", 3, None, 1)]
    assert "_row" not in _plan(out)[0]


def test_descriptions_and_dates_in_one_pass(spark):
    said = {"Betaling:  Salaris  maart": "Salaris maart", "Betaling: Payment: Transfer: x": "x", "Transfer: Betaling: x": "Betaling: x", " Payment:\tx ": "x",
            "Betaling:Betaling: x": "Betaling: x", "Transfer:": "", "xTransfer: y": "xTransfer: y", "": None, None: None, "  ": "", "betaling: x": "betaling: x"}
    rows = spark.createDataFrame([(k,) for k in said], "t string")
    out = rows.select("t", text.clean_description(F.col("t")).alias("d"))
    assert {r.t: r.d for r in out.collect()} == said
    assert _plan(out)[0].count("regexp_replace") == 2
    days = {"1-2-2024": dt.datetime(2024, 2, 1), "01-02-2024": dt.datetime(2024, 2, 1), "2024-02-01": dt.datetime(2024, 2, 1), "onbekend": None, "": None, None: None,
            "2024-02-01T10:00:00": dt.datetime(2024, 2, 1, 10), "31-31-2024": None}
    read = spark.createDataFrame([(k,) for k in days], "t string").select("t", dates.dutch_date(F.col("t")).alias("d"))
    assert {r.t: r.d for r in read.collect()} == days


def test_facts_hold_accounts_and_not_their_rows(spark):
    stg = spark.createDataFrame([("t1", "A1", None), ("t2", "A1", "B1"), ("t3", None, "B1")], "transaction_id string, iban_from string, iban_to string").selectExpr(
        "*", "'c' AS investigation_id", "'s' AS source_id", "DATE '2024-01-01' AS datum", "CAST(1 AS DECIMAL(15,2)) AS bedrag", "'w' AS omschrijving")
    dim = spark.createDataFrame([("A1", "ka", True), ("B1", "kb", True)], "iban string, account_key string, is_current boolean")
    out = models.fact_transaction(stg, dim)
    keys = {(r.transaction_id, r.account_key_from, r.account_key_to) for r in out.collect()}
    assert keys == {("t1", "ka", None), ("t2", "ka", "kb"), ("t3", None, "kb")}
    used = _plan(out)[1]
    assert used.count("ShuffledHashJoin") >= 2 and "SortMergeJoin" not in used
