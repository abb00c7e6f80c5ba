"""Table contracts, file profiles and SQL functions as queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import in_sql
from ..operators import contracts, quality
from . import layers as L
from .quality_queries import _failing
from .registry import query, stage

# ---- contracts ------------------------------------------------------------------------------


def sql_tests(contract: dict, have: set[str]) -> list[tuple[str, str, str]]:
    """(rule, column, condition of a failing row) of a contract; a column outside ``have`` is null in every row."""
    def ref(c):
        return c if c in have else "NULL"

    out = [("required", c, f"{ref(c)} IS NULL") for c in contract.get("required", ())]
    for c, spec in contract["properties"].items():
        x, string = ref(c), f"CAST({ref(c)} AS VARCHAR)"
        told = {"min_length": f"length({string}) < {spec.get('minLength')}", "max_length": f"length({string}) > {spec.get('maxLength')}",
                "pattern": f"NOT regexp_matches({string}, '{spec.get('pattern')}')",
                "uuid": f"NOT regexp_matches({string}, '{contracts.UUID}')",
                "enum": f"{x} NOT IN ({', '.join(repr(v) for v in spec.get('enum', ()))})",
                "minimum": f"{x} < {spec.get('minimum')}", "maximum": f"{x} > {spec.get('maximum')}"}
        present = {"min_length": "minLength" in spec, "max_length": "maxLength" in spec, "pattern": "pattern" in spec,
                   "uuid": spec.get("format") == "uuid", "enum": "enum" in spec, "minimum": "minimum" in spec, "maximum": "maximum" in spec}
        out += [(rule, c, cond) for rule, cond in told.items() if present[rule]]
    return out


def sql_contract(table: str, contract: dict, have: str, more=(), shape=()) -> str:
    tests = sql_tests(contract, set(have.split())) + list(more)
    counts = ", ".join(f"{{'rule': '{r}', 'column': '{c}', 'checked': count(*), 'failed': count(*) FILTER (WHERE {cond})}}" for r, c, cond in tests)
    found = "".join(f"\nUNION ALL SELECT '{r}', '{c}', 1, 1, false" for r, c in shape)
    return (f"""SELECT r.rule AS rule, r."column" AS "column", r.checked AS checked, r.failed AS failed, r.failed = 0 AS passed"""
            f" FROM (SELECT unnest([{counts}]) AS r FROM {table}) q{found}")


stage("st_canon_tx_whole", "SELECT *, 'wire' AS payment_method, false AS is_reversal, '{}' AS source_raw_data FROM st_canon_tx")
stage("st_canon_comm_whole", """
SELECT *, 'msisdn' AS originator_type, 'msisdn' AS recipient_type, 'telecom_a' AS network_operator, '{}' AS source_raw_data FROM st_canon_comm""")

EXTRA = [("extra_column", "validation_errors"), ("extra_column", "validation_warnings")]


@query("contract_transactions", sql_contract(
    "st_canon_tx_whole", contracts.TRANSACTION,
    "source_system_id source_record_id investigation_id transaction_datetime amount currency_code debtor_account_id debtor_account_type debtor_name"
    " creditor_account_id creditor_account_type creditor_name transaction_type payment_method reference_number data_completeness_score"
    " validation_status source_raw_data",
    [("check", "amount", "amount IS NOT NULL AND (amount = 0) = (currency_code IS NOT NULL)")], EXTRA))
def contract_transactions(d):
    return contracts.contract_check(L.canon_tx(d), contracts.TRANSACTION, contracts.transaction_checks())


@query("contract_communications", sql_contract(
    "st_canon_comm_whole", contracts.COMMUNICATION,
    "source_system_id source_record_id investigation_id communication_type communication_datetime duration_seconds originator_id originator_type"
    " recipient_id recipient_type direction call_status content_hash network_operator connection_type validation_status source_raw_data",
    [("required_if", "duration_seconds", "communication_type = 'call' AND duration_seconds IS NULL")], EXTRA))
def contract_communications(d):
    return contracts.contract_check(L.canon_comm(d), contracts.COMMUNICATION)


@query("contract_persons", sql_contract(
    "fx_persons", contracts.PERSON, "person_type identifier_type person_role risk_level confidence_score data_completeness_pct"))
def contract_persons(d):
    return contracts.contract_check(d.fx_persons, contracts.PERSON)


@query("contract_cases", sql_contract(
    "fx_cases", contracts.CASE, "name status start_date end_date lead_investigator", [("check", "end_date", "end_date < start_date")]))
def contract_cases(d):
    return contracts.contract_check(d.fx_cases, contracts.CASE, contracts.case_checks())


query("test_phone_format", r"""
SELECT call_id, callee FROM fx_calls WHERE NOT (length(callee) BETWEEN 10 AND 15 AND (regexp_matches(callee, '^(06|\+316)[0-9]{8}$')
  OR regexp_matches(callee, '^(0[1-57-9]|\+31[1-57-9])[0-9]{7,8}$') OR regexp_matches(callee, '^\+[0-9]{10,14}$')))""")(
    lambda d: d.fx_calls.where(quality.phone_format("callee")).select("call_id", "callee"))


@query("quality_badges", """
SELECT source, quality_score, CASE WHEN quality_score >= 95 THEN 'high-quality' WHEN quality_score >= 80 THEN 'good-quality' ELSE 'needs-attention' END AS badge
FROM (SELECT 'weather' AS source, round(count(*) FILTER (WHERE failed_rows = 0) * 100.0e0 / 7, 2) AS quality_score FROM st_weather_checks
      UNION ALL SELECT 'transactions', round(CAST(count(*) FILTER (WHERE validation_status = 'valid') AS DOUBLE) * 100 / count(*), 2) FROM st_canon_tx
      UNION ALL SELECT 'communications', round(CAST(count(*) FILTER (WHERE validation_status = 'valid') AS DOUBLE) * 100 / count(*), 2) FROM st_canon_comm) s""")
def quality_badges(d):
    scores = quality.weather_quality(d.fx_observations).select(F.lit("weather").alias("source"), "quality_score").limit(1)
    for name, rows in (("transactions", L.canon_tx(d)), ("communications", L.canon_comm(d))):
        scores = scores.unionByName(quality.mapping_quality(rows).select(F.lit(name).alias("source"), "quality_score"))
    return scores.withColumns({"quality_score": F.col("quality_score").cast("double"), "badge": quality.quality_badge(F.col("quality_score"))})


# ---- profiles -------------------------------------------------------------------------------

NUMBERS = ("row_count", "column_count", "null_count", "null_pct", "amount_sum", "amount_mean", "amount_min", "amount_max", "amount_std", "unique_ibans",
           "duration_total", "duration_max", "duration_mean", "duplicate_rows", "duplicate_pct", "unique_phone_numbers", "total_phone_numbers")


def profile(rows, kind):
    """Numbers as numbers, so that engines need not write them alike; times to the second."""
    found = quality.profile_dataset(rows, kind)
    is_number = F.col("metric").isin(*NUMBERS)
    return found.select("metric", "column", F.when(is_number, F.col("value").cast("double")).alias("number"),
                        F.when(~is_number, F.left("value", F.lit(19))).alias("text"))


def sql_profile(table: str, kinds: dict[str, str], more: list[tuple[str, str, str, str]], tail: str = "") -> str:
    """``more``: (metric, column, number, text) expressions over the table."""
    rows = [("row_count", "", "count(*)", "NULL"), ("column_count", "", str(len(kinds)), "NULL")]
    for c, kind in kinds.items():
        rows += [("null_count", c, f"count(*) FILTER (WHERE {c} IS NULL)", "NULL"),
                 ("null_pct", c, f"round(count(*) FILTER (WHERE {c} IS NULL) * 100.0e0 / count(*), 2)", "NULL"), ("dtype", c, "NULL", f"'{kind}'")]
    packed = ", ".join(f"{{'metric': '{m}', 'column': '{c}', 'number': CAST({n} AS DOUBLE), 'text': CAST({t} AS VARCHAR)}}" for m, c, n, t in rows + more)
    names = ", ".join(kinds)
    return f"""SELECT r.metric AS metric, r."column" AS "column", r.number AS number, r.text AS text FROM (SELECT unnest([{packed}]) AS r FROM {table}) q
UNION ALL SELECT 'duplicate_rows', '', CAST(sum(n - 1) AS DOUBLE), NULL FROM (SELECT count(*) AS n FROM {table} GROUP BY {names}) a
UNION ALL SELECT 'duplicate_pct', '', round(sum(n - 1) * 100.0e0 / sum(n), 2), NULL FROM (SELECT count(*) AS n FROM {table} GROUP BY {names}) b{tail}"""


def sql_phones(table: str, a: str, b: str) -> str:
    both = f"(SELECT {a} AS p FROM {table} UNION ALL SELECT {b} FROM {table}) u"
    return "".join(f"\nUNION ALL SELECT '{m}_phone_numbers', '', CAST(count({k}p) AS DOUBLE), NULL FROM {both}" for m, k in (("unique", "DISTINCT "), ("total", "")))


# Whole numbers and texts as they leave intake; a third of the rows twice.
stage("st_bank_file", """
SELECT o.n AS n, investigation_id, iban, bedrag, datum, omschrijving FROM fx_transactions, (SELECT 1 AS n) o
UNION ALL SELECT 1, investigation_id, iban, bedrag, datum, omschrijving FROM fx_transactions WHERE investigation_id = 'OND-2025-000001'""")


@query("file_profile_bank", sql_profile(
    "st_bank_file", {"n": "int", "investigation_id": "string", "iban": "string", "bedrag": "decimal(15,2)", "datum": "date", "omschrijving": "string"},
    [("amount_sum", "bedrag", "sum(bedrag)", "NULL"), ("amount_mean", "bedrag", "round(avg(CAST(bedrag AS DOUBLE)), 4)", "NULL"),
     ("amount_min", "bedrag", "min(bedrag)", "NULL"), ("amount_max", "bedrag", "max(bedrag)", "NULL"),
     ("amount_std", "bedrag", "round(stddev_samp(CAST(bedrag AS DOUBLE)), 4)", "NULL"), ("unique_ibans", "iban", "count(DISTINCT iban)", "NULL"),
     ("first_date", "datum", "NULL", "min(datum)"), ("last_date", "datum", "NULL", "max(datum)")]))
def file_profile_bank(d):
    rows = d.fx_transactions.select(F.lit(1).alias("n"), "investigation_id", "iban", "bedrag", "datum", "omschrijving")
    return profile(rows.unionByName(rows.where("investigation_id = 'OND-2025-000001'")), "bank_transactions")


@query("file_profile_calls", sql_profile(
    "(SELECT caller, callee, timestamp, duration_seconds, call_type FROM fx_calls) c",
    {"caller": "string", "callee": "string", "timestamp": "timestamp_ntz", "duration_seconds": "int", "call_type": "string"},
    [("first_timestamp", "timestamp", "NULL", "strftime(min(timestamp), '%Y-%m-%d %H:%M:%S')"), ("last_timestamp", "timestamp", "NULL", "strftime(max(timestamp), '%Y-%m-%d %H:%M:%S')"),
     ("duration_total", "duration_seconds", "sum(duration_seconds)", "NULL"), ("duration_max", "duration_seconds", "max(duration_seconds)", "NULL"),
     ("duration_mean", "duration_seconds", "round(avg(duration_seconds), 4)", "NULL")], sql_phones("fx_calls", "caller", "callee")))
def file_profile_calls(d):
    at = F.col("timestamp").cast("timestamp_ntz").alias("timestamp")
    return profile(d.fx_calls.select("caller", "callee", at, "duration_seconds", "call_type"), "call_records")


@query("file_profile_messages", sql_profile(
    "(SELECT sender, recipient, message_text FROM fx_messages) m", {"sender": "string", "recipient": "string", "message_text": "string"}, [],
    sql_phones("fx_messages", "sender", "recipient")))
def file_profile_messages(d):
    return profile(d.fx_messages.select("sender", "recipient", "message_text"), "sms_records")


# ---- functions in SQL -----------------------------------------------------------------------


def in_session(d, sql: str):
    """A statement that calls the registered functions, over the derived inputs it names."""
    in_sql.register(d.spark, "cm_")
    for name in ("fx_transactions", "fx_calls", "fx_cases"):
        if name in sql:
            getattr(d, name).createOrReplaceTempView(name)
    return d.spark.sql(sql)


@query("sql_functions_iban", """
SELECT transaction_id, coalesce(regexp_matches(iban, '^[A-Z]{2}[0-9]{2}[A-Z0-9]{11,30}$'), false) AS is_valid, left(iban, 2) AS country, code AS bank_code,
  CASE code WHEN 'ABNA' THEN 'ABN AMRO' WHEN 'INGB' THEN 'ING Bank' WHEN 'RABO' THEN 'Rabobank' ELSE 'Unknown Bank' END AS bank_name,
  left(iban, 8) || '****' || right(iban, 4) AS masked, md5(iban) AS digest
FROM (SELECT *, substr(iban, 5, CASE left(iban, 2) WHEN 'BE' THEN 3 WHEN 'DE' THEN 8 ELSE 4 END) AS code FROM fx_transactions) t""")
def sql_functions_iban(d):
    return in_session(d, """
        SELECT transaction_id, cm_validate_iban(iban) AS is_valid, cm_extract_country_from_iban(iban) AS country, cm_extract_bank_code_from_iban(iban) AS bank_code,
          cm_get_bank_name_from_code(cm_extract_bank_code_from_iban(iban)) AS bank_name, cm_mask_iban(iban) AS masked, cm_hash_sensitive_data(iban) AS digest
        FROM fx_transactions""")


@query("sql_functions_phone", r"""
SELECT call_id, length(caller) BETWEEN 10 AND 15 AND (regexp_matches(caller, '^(06|\+316)[0-9]{8}$') OR regexp_matches(caller, '^(0[1-57-9]|\+31[1-57-9])[0-9]{7,8}$')
    OR regexp_matches(caller, '^\+[0-9]{10,14}$')) AS is_valid,
  CASE WHEN regexp_matches(callee, '^(06[0-9]{8}|0[1-57-9][0-9]{7,8})$') THEN '+31' || substr(callee, 2) WHEN regexp_matches(callee, '^\+[0-9]+$') THEN callee ELSE '+31' || callee END AS normal,
  CASE WHEN starts_with(callee, '+') THEN left(callee, 3) ELSE '+31' END AS country_code,
  CASE WHEN regexp_matches(caller, '^(\+316|06)') THEN 'mobile' WHEN regexp_matches(caller, '^(\+31[1-57-9]|0[1-57-9])') THEN 'landline'
    WHEN regexp_matches(caller, '^\+[0-9]{2}[6-9]') THEN 'mobile' ELSE 'unknown' END AS phone_type,
  CASE WHEN regexp_matches(caller, '^(\+316|06)[0-2]') THEN 'KPN' WHEN regexp_matches(caller, '^(\+316|06)[3-5]') THEN 'Vodafone'
    WHEN regexp_matches(caller, '^(\+316|06)[6-8]') THEN 'T-Mobile' ELSE 'Unknown' END AS provider,
  left(caller, 4) || '****' || right(caller, 3) AS masked, CAST(timestamp AS DATE) AS day
FROM fx_calls""")
def sql_functions_phone(d):
    return in_session(d, """
        SELECT call_id, cm_validate_phone_number(caller) AS is_valid, cm_normalize_phone_number(callee) AS normal, cm_extract_country_code_from_phone(callee) AS country_code,
          cm_get_phone_type(caller) AS phone_type, cm_detect_phone_provider(caller) AS provider, cm_mask_phone(caller) AS masked, cm_extract_date(CAST(timestamp AS TIMESTAMP_NTZ)) AS day
        FROM fx_calls""")


@query("sql_functions_age", """
SELECT investigation_id, CAST(date_sub('year', start_date, DATE '2030-02-15') AS BIGINT) AS years FROM fx_cases WHERE date_sub('year', start_date, DATE '2030-02-15') >= 5""")
def sql_functions_age(d):
    return in_session(d, """
        SELECT investigation_id, cm_calculate_age(start_date, DATE '2030-02-15') AS years FROM fx_cases WHERE cm_calculate_age(start_date, DATE '2030-02-15') >= 5""")


# `_failing` of the row rules, through a function: the same rows as `test_iban_format`.
@query("test_iban_in_sql", "SELECT transaction_id FROM fx_transactions WHERE NOT regexp_matches(iban, '^[A-Z]{2}[0-9]{2}[A-Z0-9]{11,30}$')")
def test_iban_in_sql(d):
    in_sql.register(d.spark, "cm_")
    return _failing(d, F.expr("iban IS NOT NULL AND NOT cm_validate_iban(iban)"))
