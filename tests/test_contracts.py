"""Contracts, SQL functions and versioned tables on small tables."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from casemill.functions import dates, iban, in_sql, mask, phone
from casemill.operators import contracts
from casemill.sources.versions import NoSuchVersion, check_version, list_versions, read_version, write_version


def told(df):
    return {(r["rule"], r["column"]): (r["checked"], r["failed"]) for r in df.collect()}


def test_every_declaration_has_a_row(spark):
    rows = spark.createDataFrame([("a", 1), (None, 2)], "source_system_id string, extra int")
    for contract in (contracts.TRANSACTION, contracts.COMMUNICATION):
        found = told(contracts.contract_check(rows, contract))
        for c in contract["required"]:
            assert found[("required", c)] == (2, 1 if c == "source_system_id" else 2)
            assert (("missing_column", c) in found) == (c != "source_system_id")
        for c, spec in contract["properties"].items():
            for key, rule in (("maxLength", "max_length"), ("pattern", "pattern"), ("enum", "enum"), ("minimum", "minimum"), ("maximum", "maximum")):
                assert ((rule, c) in found) == (key in spec)
        assert found[("extra_column", "extra")] == (1, 1)


def test_rules_by_hand(spark):
    contract = {"required": ["a"], "properties": {
        "a": {"type": ["string", "null"], "minLength": 2, "maxLength": 3, "pattern": "^x"}, "b": {"type": "integer", "minimum": 0, "maximum": 5},
        "c": {"type": "string", "enum": ["p", "q", None]}, "d": {"type": "string", "format": "uuid"}, "odd name": {"type": "number"}},
        "allOf": [{"if": {"properties": {"c": {"const": "p"}}}, "then": {"required": ["b"]}}]}
    rows = spark.createDataFrame([("x", -1, "p", "no"), ("xyzw", 6, "r", "123e4567-e89b-12d3-a456-426614174000"), ("yy", None, "p", None), (None, None, None, ""), ("xx", 5, "q", None)],
                                 "a string, b int, c string, d string").withColumn("odd name", F.lit("text"))
    found = told(contracts.contract_check(rows, contract))
    wanted = {("required", "a"): 1, ("min_length", "a"): 1, ("max_length", "a"): 1, ("pattern", "a"): 1, ("minimum", "b"): 1, ("maximum", "b"): 1,
              ("enum", "c"): 1, ("uuid", "d"): 2, ("required_if", "b"): 1}
    assert found == {**{k: (5, n) for k, n in wanted.items()}, ("type", "odd name"): (1, 1)}
    assert {k: n for k, (_, n) in told(contracts.contract_check(rows.limit(0), contract)).items() if n} == {("type", "odd name"): 1}


def test_amount_and_currency(spark):
    rows = spark.createDataFrame([(None, None), (0, None), (0, "EUR"), (1, None), (1, "EUR")], "amount int, currency_code string")
    found = told(contracts.contract_check(rows, {"properties": {}}, contracts.transaction_checks()))
    assert found == {("check", "amount"): (5, 2)}


IBANS = [None, "", "NL91ABNA0417164300", "BE71096123456769", "DE89370400440532013000", "nl91abna0417164300", "NL91", "FR1420041010050500013M02606"]
PHONES = [None, "", "0612345678", "+31612345678", "0207654321", "+31207654321", "+4930123456789", "12345", "+3261234567", "0691234567", "06-12"]


@pytest.mark.parametrize("name, ours, values", [
    ("validate_iban", iban.valid_strict, IBANS), ("extract_country_from_iban", iban.country, IBANS), ("extract_bank_code_from_iban", iban.bank_code, IBANS),
    ("get_bank_name_from_code", iban.bank_name, ["ABNA", "KNAB", "ZZZZ", ""]), ("validate_phone_number", phone.valid, PHONES),
    ("normalize_phone_number", phone.normalize_nl, PHONES), ("extract_country_code_from_phone", phone.country_code, PHONES),
    ("get_phone_type", phone.phone_type, PHONES), ("detect_phone_provider", phone.provider, PHONES), ("hash_sensitive_data", mask.digest, IBANS),
    ("mask_iban", mask.iban_long, IBANS), ("mask_phone", mask.phone_edges, PHONES)])
def test_sql_function_equals_column_function(spark, name, ours, values):
    in_sql.register(spark, "t_")
    rows = spark.createDataFrame([(v,) for v in values], "x string")
    for r in rows.select("x", F.expr(f"t_{name}(x)").alias("sql"), ours(F.col("x")).alias("column")).collect():
        assert r["sql"] == r["column"], r


def test_sql_functions_are_inlined(spark):
    in_sql.register(spark, "t_")
    plan = spark.range(3).selectExpr("cast(id as string) x").where("t_validate_iban(x)")._jdf.queryExecution().optimizedPlan().toString()
    assert "t_validate_iban" not in plan and "RLIKE" in plan


def test_versions(spark, tmp_path):
    root = str(tmp_path / "table")
    with pytest.raises(NoSuchVersion):
        read_version(spark, root)
    assert list_versions(spark, root).count() == 0
    assert write_version(spark.range(5), root, "five") == 1
    assert write_version(spark.range(7).withColumn("p", F.col("id") % 2), root, parts=["p"]) == 2
    assert read_version(spark, root).count() == 7 and read_version(spark, root, name="five").count() == 5
    assert [(r["version"], r["name"], r["rows"], list(r["parts"])) for r in list_versions(spark, root).orderBy("version").collect()] == [
        (1, "five", 5, []), (2, "2", 7, ["p"])]
    assert check_version(spark, root) and check_version(spark, root, 1) and not check_version(spark, root, 9)
    with pytest.raises(ValueError):
        write_version(spark.range(1), root, "five")
    assert write_version(spark.range(0), root) == 3 and read_version(spark, root).count() == 0


def test_a_write_cut_short_is_not_seen(spark, tmp_path):
    root = str(tmp_path / "table")
    write_version(spark.range(5), root)
    half = spark.range(0, 1000, 1, 4).withColumn("bad", F.when(F.col("id") == 990, F.raise_error(F.lit("cut"))).otherwise(F.col("id").cast("string")))
    with pytest.raises(Exception, match="cut"):
        write_version(half, root)
    assert read_version(spark, root).count() == 5 and list_versions(spark, root).count() == 1
    assert write_version(spark.range(6), root) == 2 and read_version(spark, root).count() == 6


def test_age_in_sql(spark):
    in_sql.register(spark, "t_")
    row = spark.sql("SELECT t_calculate_age(DATE '2000-02-29', DATE '2023-02-28') AS a, t_calculate_age(DATE '2000-02-29', DATE '2024-02-29') AS b").first()
    born, day = F.lit(dt.date(2000, 2, 29)), F.lit(dt.date(2023, 2, 28))
    assert spark.range(1).select(dates.age_years(born, day)).first()[0] == 22
    assert (row["a"], row["b"]) == (22, 24) and spark.sql("SELECT t_extract_date(TIMESTAMP_NTZ '2024-01-02 23:59:00') AS d").first()["d"] == dt.date(2024, 1, 2)
