"""Intake cleaning, canonical mapping, staging, dimensions and facts."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F

from ..functions import dates, iban, phone, text
from ..operators import canonical, clean, keyed
from . import layers as L
from .registry import query

CLEAN_AMOUNT = ("CASE WHEN contains(t, ',') THEN try_cast(replace(replace(t, '.', ''), ',', '.') AS DECIMAL(15,2)) "
                "ELSE try_cast(t AS DECIMAL(15,2)) END")


def bank_text(d):
    """Transactions as a bank would deliver them: every second amount in Dutch notation, dates as text."""
    tx, dutch = d.fx_transactions, F.col("trade_no") % 2 == 0
    n = F.regexp_extract("transaction_id", "([0-9]+)$", 1).cast("bigint")
    amount = F.col("bedrag").cast("string")
    return tx.withColumn("trade_no", n).select(
        "transaction_id", F.concat(F.lit(" "), F.lower("iban")).alias("rekeningnummer"),
        F.col("tegenrekening_iban").alias("to_account"),
        F.when(dutch, F.translate(amount, ".", ",")).otherwise(amount).alias("Bedrag (EUR)"),
        F.when(dutch, F.date_format("datum", "dd-MM-yyyy")).otherwise(F.date_format("datum", "yyyy-MM-dd")).alias("trans_date"),
        F.col("omschrijving").alias("narrative"))


BANK_CLEAN_SQL = """
SELECT transaction_id, upper(trim(iban)) AS iban, tegenrekening_iban, CAST(bedrag AS DOUBLE) AS bedrag, datum, omschrijving,
  coalesce(regexp_matches(upper(trim(iban)), '^[A-Z]{2}[0-9]{2}[A-Z0-9]+$'), false) AS iban_valid FROM fx_transactions"""


@query("bank_unify_columns", """
SELECT transaction_id, ' ' || lower(iban) AS iban, tegenrekening_iban,
  CASE WHEN CAST(substr(transaction_id, 4) AS BIGINT) % 2 = 0 THEN replace(CAST(bedrag AS VARCHAR), '.', ',') ELSE CAST(bedrag AS VARCHAR) END AS bedrag,
  CASE WHEN CAST(substr(transaction_id, 4) AS BIGINT) % 2 = 0 THEN strftime(datum, '%d-%m-%Y') ELSE strftime(datum, '%Y-%m-%d') END AS datum,
  omschrijving FROM fx_transactions""")
def bank_unify(d):
    return clean.unify_columns(clean.lower_header(bank_text(d)), clean.BANK_ALIASES)


@query("bank_clean", BANK_CLEAN_SQL)
def bank_clean(d):
    return clean.bank_clean(bank_unify(d))


@query("telecom_unify_columns", "SELECT call_id, caller, callee, duration_seconds, timestamp FROM fx_calls")
def telecom_unify(d):
    told = d.fx_calls.select("call_id", F.col("caller").alias("From_Number"), F.col("callee").alias("calling_number_b"),
                             F.col("duration_seconds").alias("call_duration"), "timestamp")
    return clean.unify_columns(clean.lower_header(told.withColumnRenamed("calling_number_b", "destination")),
                               clean.TELECOM_ALIASES)


@query("telecom_clean", """
SELECT call_id, regexp_replace(regexp_replace(caller, '[\\s\\-()]', '', 'g'), '^\\+', '00') AS caller,
  regexp_replace(regexp_replace(callee, '[\\s\\-()]', '', 'g'), '^\\+', '00') AS callee,
  CASE WHEN duration_seconds >= 0 THEN duration_seconds END AS duration_seconds, timestamp FROM fx_calls""")
def telecom_clean(d):
    s = F.col("duration_seconds")
    two = lambda c: F.lpad(F.floor(c).cast("string"), 2, "0")
    clock = F.concat_ws(":", F.floor(s / 3600).cast("string"), two(s % 3600 / 60), two(s % 60))
    said = (F.when(s < 0, "n/a").when(F.hash("call_id") % 2 == 0, clock).otherwise(s.cast("string")))
    raw = d.fx_calls.select("call_id", "caller", "callee", said.alias("duration_seconds"),
                            F.col("timestamp").cast("string").alias("timestamp"))
    return clean.telecom_clean(raw)


@query("load_raw_rows", """
SELECT transaction_id, investigation_id, source_id, iban AS iban_from, tegenrekening_iban AS iban_to, CAST(bedrag AS DOUBLE) AS bedrag,
  datum, omschrijving, kenmerk AS json_kenmerk, naam_naar AS json_naam_naar FROM fx_transactions""")
def load_raw_rows(d):
    j = lambda k: F.get_json_object("raw_data", f"$.{k}").alias(f"json_{k}")
    return L.raw_tx(d).select("*", j("kenmerk"), j("naam_naar")).drop("raw_data")


TX_COLUMNS = ("source_system_id, source_record_id, investigation_id, transaction_datetime, posting_date, value_date, "
              "CAST(amount AS DOUBLE) AS amount, currency_code, debtor_account_id, debtor_account_type, creditor_account_id, "
              "creditor_account_type, debtor_name, creditor_name, transaction_type, payment_method, description, reference_number, "
              "is_cancelled, is_reversal, data_completeness_score, validation_status, validation_errors, validation_warnings")


@query("canonical_transactions", f"SELECT {TX_COLUMNS} FROM st_canon_tx")
def canonical_tx(d):
    return L.canon_tx(d).drop("source_file_name", "transaction_reference", "source_raw_data")


COMM_COLUMNS = ("source_system_id, source_record_id, investigation_id, communication_type, communication_datetime, "
                "CAST(duration_seconds AS BIGINT) AS duration_seconds, originator_id, 'msisdn' AS originator_type, recipient_id, "
                "'msisdn' AS recipient_type, direction, call_status, 'telecom_a' AS network_operator, connection_type, message_content, "
                "content_hash, validation_status, validation_errors, validation_warnings")


@query("canonical_calls", f"SELECT {COMM_COLUMNS} FROM st_canon_comm WHERE communication_type = 'call'")
def canonical_calls(d):
    return canonical.validate_communications(canonical.map_calls(L.raw_calls(d))).drop("source_file_name", "source_raw_data")


@query("canonical_messages", f"SELECT {COMM_COLUMNS} FROM st_canon_comm WHERE communication_type = 'sms'")
def canonical_messages(d):
    return canonical.validate_communications(canonical.map_messages(L.raw_messages(d))).drop("source_file_name", "source_raw_data")


@query("validate_transactions", """
SELECT investigation_id, validation_status, validation_errors, validation_warnings, count(*) AS n FROM st_canon_tx GROUP BY ALL""")
def validate_transactions(d):
    return L.canon_tx(d).groupBy("investigation_id", "validation_status",
                                 *[F.array_join(c, "|").alias(c) for c in ("validation_errors", "validation_warnings")]
                                 ).agg(F.count("*").alias("n"))


@query("validate_communications", """
SELECT communication_type, validation_status, validation_errors, validation_warnings, count(*) AS n FROM st_canon_comm GROUP BY ALL""")
def validate_communications(d):
    return L.canon_comm(d).groupBy("communication_type", "validation_status",
                                   *[F.array_join(c, "|").alias(c) for c in ("validation_errors", "validation_warnings")]
                                   ).agg(F.count("*").alias("n"))


@query("valid_transactions", "SELECT source_record_id, investigation_id, CAST(amount AS DOUBLE) AS amount FROM st_canon_tx WHERE validation_status = 'valid'")
def valid_transactions(d):
    return L.canon_tx(d).where("validation_status = 'valid'").select("source_record_id", "investigation_id", "amount")


@query("valid_communications", "SELECT source_record_id, communication_type FROM st_canon_comm WHERE validation_status = 'valid'")
def valid_communications(d):
    return L.canon_comm(d).where("validation_status = 'valid'").select("source_record_id", "communication_type")


# ---- increments -----------------------------------------------------------------------------

DONE = dt.date(2000, 1, 1)


@query("unmapped_transactions", "SELECT transaction_id, source_id, datum FROM fx_transactions WHERE datum >= DATE '2000-01-01'")
def unmapped_tx(d):
    done = L.canon_tx(d).where(F.col("posting_date") < F.lit(DONE))
    return canonical.unmapped(L.raw_tx(d), done, "transaction_id").select("transaction_id", "source_id", "datum")


@query("unmapped_calls", "SELECT call_id, source_id FROM fx_calls WHERE duration_seconds <= 3600")
def unmapped_calls(d):
    done = canonical.map_calls(L.raw_calls(d)).where("duration_seconds > 3600")
    return canonical.unmapped(L.raw_calls(d), done, "call_id").select("call_id", "source_id")


@query("unmapped_messages", "SELECT message_id, source_id FROM fx_messages WHERE message_text = ''")
def unmapped_messages(d):
    done = canonical.map_messages(L.raw_messages(d)).where("message_content IS NOT NULL")
    return canonical.unmapped(L.raw_messages(d), done, "message_id").select("message_id", "source_id")


@query("unmapped_counts", """
SELECT 'transaction' AS kind, count(*) AS unmapped FROM fx_transactions WHERE datum >= DATE '2000-01-01'
UNION ALL SELECT 'call', count(*) FROM fx_calls WHERE duration_seconds <= 3600
UNION ALL SELECT 'message', count(*) FROM fx_messages WHERE message_text = ''""")
def unmapped_counts(d):
    return canonical.unmapped_counts({
        "transaction": (L.raw_tx(d), L.canon_tx(d).where(F.col("posting_date") < F.lit(DONE)), "transaction_id"),
        "call": (L.raw_calls(d), canonical.map_calls(L.raw_calls(d)).where("duration_seconds > 3600"), "call_id"),
        "message": (L.raw_messages(d), canonical.map_messages(L.raw_messages(d)).where("message_content IS NOT NULL"),
                    "message_id")})


def _tx_core(d):
    return L.canon_tx(d).select("source_system_id", "source_record_id", "amount", "description", "validation_status",
                                "data_completeness_score", "posting_date")


@query("upsert_partial", """
SELECT source_system_id, source_record_id, CAST(amount AS DOUBLE) AS amount, description,
  CASE WHEN posting_date >= DATE '1997-01-01' THEN validation_status ELSE 'pending' END AS validation_status,
  CASE WHEN posting_date >= DATE '1997-01-01' THEN data_completeness_score ELSE 0 END AS data_completeness_score, posting_date
FROM st_canon_tx""")
def upsert_partial(d):
    """Rows before 2000 are stored as pending; a later run brings new states for all rows since 1997."""
    rows = L.kept(d, _tx_core(d), "upsert-rows")
    old = rows.where("posting_date < DATE '2000-01-01'").withColumns(
        {"validation_status": F.lit("pending"), "data_completeness_score": F.lit(0)})
    new = rows.where("posting_date >= DATE '1997-01-01'").withColumn(
        "description", F.when(F.col("posting_date") < F.lit(DONE), "changed later").otherwise(F.col("description")))
    return keyed.upsert_partial(old, new, ["source_system_id", "source_record_id"],
                                ["validation_status", "data_completeness_score"], ["posting_date"])


@query("upsert_latest", """
SELECT station_name, timestamp, max(CASE WHEN r = 1 THEN temperature END) AS temperature, max(CASE WHEN r = 1 THEN humidity END) AS humidity,
  max(CASE WHEN r = 1 THEN ingestion_time END) AS ingestion_time
FROM (SELECT *, row_number() OVER (PARTITION BY station_name, timestamp ORDER BY (humidity >= 50) DESC, ingestion_time DESC) AS r
      FROM fx_observations) q GROUP BY ALL""")
def upsert_latest(d):
    """Dry observations are stored; humid ones arrive and replace them per station and minute."""
    cols = ["station_name", "timestamp", "temperature", "humidity", "ingestion_time"]
    obs = d.fx_observations.select(*cols)
    return keyed.upsert_latest(obs.where("humidity < 50"), obs.where("humidity >= 50"), ["station_name", "timestamp"],
                               ["ingestion_time"])


@query("insert_absent", """
SELECT source_id, record_no, transaction_id FROM (
  SELECT source_id, datum AS record_no, transaction_id, row_number() OVER (PARTITION BY source_id, datum ORDER BY transaction_id) AS r,
    bool_or(bedrag < 0) OVER (PARTITION BY source_id, datum) AS has_old, coalesce(bedrag < 0, false) AS is_old
  FROM fx_transactions) q WHERE is_old OR (NOT coalesce(has_old, false) AND r = 1)""")
def insert_absent(d):
    """Debits are stored; of the other rows the first of a source and day comes in when that day is still empty."""
    tx = d.fx_transactions.withColumn("record_no", F.col("datum"))
    cols = ["source_id", "record_no", "transaction_id"]
    old, new = tx.where("bedrag < 0"), tx.where("bedrag >= 0 OR bedrag IS NULL")
    return keyed.insert_absent(old.select(*cols), new.select(*cols), ["source_id", "record_no"], ["transaction_id"])


# ---- expressions ----------------------------------------------------------------------------


@query("iban_quality", f"""
SELECT transaction_id, coalesce(regexp_matches(iban, '^[A-Z]{{2}}[0-9]{{2}}[A-Z0-9]{{11,30}}$'), false) AS strict,
  {L.sql_loose('iban')} AS loose, {L.sql_iban('iban')} AS normal FROM fx_transactions""")
def iban_quality(d):
    c = F.col("iban")
    return d.fx_transactions.select("transaction_id", iban.valid_strict(c).alias("strict"),
                                    iban.valid_loose(c).alias("loose"), iban.normalize(c).alias("normal"))


@query("phone_quality", f"""
SELECT call_id, {L.sql_e164('caller')} AS caller, {L.sql_e164('callee')} AS callee,
  coalesce(regexp_matches({L.sql_e164('caller')}, '^\\+[1-9][0-9]{{1,14}}$'), false) AS caller_ok,
  coalesce(regexp_matches({L.sql_e164('callee')}, '^\\+[1-9][0-9]{{1,14}}$'), false) AS callee_ok FROM fx_calls""")
def phone_quality(d):
    a, b = phone.e164(F.col("caller")), phone.e164(F.col("callee"))
    return d.fx_calls.select("call_id", a.alias("caller"), b.alias("callee"), phone.valid_e164(a).alias("caller_ok"),
                             phone.valid_e164(b).alias("callee_ok"))


CURRENCY_CASE = "CASE o_orderkey % 8 WHEN 0 THEN '€' WHEN 1 THEN 'usd' WHEN 2 THEN 'Euro' WHEN 3 THEN 'XYZ' WHEN 4 THEN NULL WHEN 5 THEN '£' WHEN 6 THEN 'dollar' ELSE 'CHF' END"


@query("currency_quality", f"""
SELECT o_orderkey, code, coalesce(code IN ('EUR','USD','GBP','CHF','JPY','AUD','CAD','SEK','NOK','DKK','PLN','CZK','HUF'), false) AS known
FROM (SELECT o_orderkey, CASE upper(c) WHEN '€' THEN 'EUR' WHEN '$' THEN 'USD' WHEN '£' THEN 'GBP' WHEN 'EURO' THEN 'EUR'
        WHEN 'DOLLAR' THEN 'USD' ELSE upper(c) END AS code FROM (SELECT o_orderkey, {CURRENCY_CASE} AS c FROM orders) a) b""")
def currency_quality(d):
    code = text.normalize_currency(F.expr(CURRENCY_CASE))
    return d.orders.select("o_orderkey", code.alias("code"), text.valid_currency(code).alias("known"))


@query("date_parse", """
SELECT transaction_id, CAST(try_strptime(valutadatum, ['%Y-%m-%d', '%d-%m-%Y']) AS DATE) AS value_day,
  CAST(datum AS TIMESTAMP) + coalesce(try_strptime(tijd, ['%H:%M:%S', '%H:%M']) - TIMESTAMP '1900-01-01', INTERVAL 0 SECOND) AS moment
FROM fx_transactions""")
def date_parse(d):
    return d.fx_transactions.select(
        "transaction_id", dates.dutch_date(F.col("valutadatum")).cast("date").alias("value_day"),
        dates.dutch_datetime(F.date_format("datum", "yyyy-MM-dd"), F.col("tijd")).alias("moment"))


@query("age_years", "SELECT o_orderkey, date_sub('year', CAST(o_orderdate AS DATE), DATE '2025-11-15') AS age FROM orders")
def age_years(d):
    return d.orders.select("o_orderkey", dates.age_years(F.to_date("o_orderdate"), F.lit(dt.date(2025, 11, 15))).alias("age"))


@query("content_hash", """
SELECT doc_id, sha256(text) AS sha256, sha1(text) AS sha1, md5(text) AS md5 FROM documents""")
def content_hash(d):
    return d.documents.select("doc_id", F.sha2("text", 256).alias("sha256"), F.sha1("text").alias("sha1"), F.md5("text").alias("md5"))


# ---- staging and models ---------------------------------------------------------------------

STG_TX = ("transaction_id, investigation_id, source_id, iban_from, iban_to, CAST(bedrag AS DOUBLE) AS bedrag, datum, posting_date, "
          "value_date, omschrijving, debtor_name, creditor_name, transaction_type, payment_method, currency_code, validation_status, "
          "data_completeness_score")

query("stg_bank_transactions", f"SELECT {STG_TX} FROM st_stg_tx")(L.stg_tx)
query("stg_telecom_calls", "SELECT * REPLACE (CAST(duration_seconds AS BIGINT) AS duration_seconds) FROM st_stg_calls")(L.stg_calls)
query("stg_telecom_messages", "SELECT * FROM st_stg_msgs")(L.stg_messages)
query("dim_bank_account", f"""
SELECT *, {L.SQL_AS_OF} AS valid_from, CAST(NULL AS TIMESTAMP) AS valid_to, true AS is_current, 'consolidated' AS source_system
FROM st_dim_bank""")(L.dim_bank)
query("dim_phone_number", f"""
SELECT *, true AS is_valid, {L.SQL_AS_OF} AS valid_from, CAST(NULL AS TIMESTAMP) AS valid_to, true AS is_current,
  'demo_system' AS source_system FROM st_dim_phone""")(L.dim_phone)
query("fact_transaction", "SELECT * REPLACE (CAST(amount AS DOUBLE) AS amount) FROM st_fact_tx")(L.fact_tx)
query("fact_call", "SELECT * FROM st_fact_call")(L.fact_calls)
query("fact_message", "SELECT * FROM st_fact_msg")(L.fact_messages)
