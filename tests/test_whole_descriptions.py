"""Descriptions stay whole, and category words behind character 1,000 count."""

from pyspark.sql import functions as F

from casemill.functions import text


def test_descriptions_stay_whole(spark):
    long = "word " * 250 + "huur"
    rows = spark.createDataFrame([(1, "Betaling:  " + long), (2, ""), (3, None), (4, "Payment: a")], "k int, d string")
    whole = text.clean_description(F.col("d"))
    cut = text.clean_description(F.col("d"), text.DESCRIPTION_LENGTH)
    got = {r.k: (r.whole, r.cut, r.kind) for r in rows.select("k", whole.alias("whole"), cut.alias("cut"), text.category(whole).alias("kind")).collect()}
    assert got == {1: (long, long[:1000], "housing"), 2: (None, None, "other"), 3: (None, None, "other"), 4: ("a", "a", "other")}
