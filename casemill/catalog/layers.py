"""The layers the queries build on, as Spark plans and as check statements of the same name."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, functions as F

from ..operators import canonical
from ..plans import cases, market, models, weather
from ..session import scratch
from .registry import Data, stage

AS_OF = dt.datetime(2001, 6, 1, 12)  # transactions after this lie in the future
ACCESS_AS_OF = dt.datetime(2025, 11, 15)
SQL_AS_OF = "TIMESTAMP '2001-06-01 12:00:00'"
SQL_ACCESS_AS_OF = "TIMESTAMP '2025-11-15 00:00:00'"


def rounded(df: DataFrame, *columns: str, places: int = 6) -> DataFrame:
    return df.withColumns({c: F.round(F.col(c).cast("double"), places) for c in columns})


def kept(d: Data, df: DataFrame, name: str) -> DataFrame:
    """The same rows as a scratch table, for what is read more than once and costly to map."""
    path = scratch(d.spark, name)
    df.write.parquet(path)
    return d.spark.read.schema(df.schema).parquet(path)


# ---- raw and canonical ----------------------------------------------------------------------


def raw_tx(d: Data) -> DataFrame:
    return canonical.raw_transactions(d.fx_transactions)


def raw_calls(d: Data) -> DataFrame:
    calls = d.fx_calls.withColumns({"call_date": F.date_format("timestamp", "yyyy-MM-dd"),
                                    "call_time": F.date_format("timestamp", "HH:mm:ss")})
    return canonical.raw_calls(calls.drop("timestamp"))


def raw_messages(d: Data) -> DataFrame:
    millis = F.unix_millis(F.col("timestamp").cast("timestamp"))
    return canonical.raw_messages(d.fx_messages.withColumn("timestamp", millis))


def canon_tx(d: Data) -> DataFrame:
    return canonical.canonical_transactions(raw_tx(d), AS_OF)


def canon_comm(d: Data) -> DataFrame:
    return canonical.canonical_communications(raw_calls(d), raw_messages(d))


def sql_e164(x: str) -> str:
    n = f"regexp_replace({x}, '[^0-9]', '', 'g')"
    return (f"nullif('+' || CASE WHEN starts_with({n}, '00') THEN substr({n}, 3)"
            f" WHEN regexp_matches({n}, '^0[1-9][0-9]{{8}}$') THEN '31' || substr({n}, 2)"
            f" WHEN length({n}) = 9 AND NOT starts_with({n}, '31') THEN '31' || {n} ELSE {n} END, '+')")


def sql_iban(x: str) -> str:
    """Capitals, packed when that is a valid account."""
    packed = f"upper(replace(replace({x}, ' ', ''), '-', ''))"
    return f"CASE WHEN regexp_matches({packed}, '{LOOSE}') THEN {packed} ELSE upper({x}) END"


LOOSE = "^[A-Z]{2}[0-9]{2}[A-Z0-9]{1,30}$"


def sql_loose(x: str) -> str:
    return f"coalesce(regexp_matches(upper(replace({x}, ' ', '')), '{LOOSE}'), false)"


def sql_describe(x: str) -> str:
    text = f"trim(regexp_replace({x}, '\\s+', ' ', 'g'))"
    for prefix in ("Betaling:", "Payment:", "Transfer:"):
        text = f"regexp_replace({text}, '^{prefix}\\s*', '')"
    return f"left(nullif({text}, ''), 1000)"


stage("st_tx_mapped", f"""
SELECT source_id AS source_system_id, transaction_id AS source_record_id, investigation_id,
  CAST(datum AS TIMESTAMP) + coalesce(try_strptime(tijd, ['%H:%M:%S', '%H:%M']) - TIMESTAMP '1900-01-01', INTERVAL 0 SECOND)
    AS transaction_datetime,
  datum AS posting_date,
  CAST(try_strptime(coalesce(valutadatum, strftime(datum, '%Y-%m-%d')), ['%Y-%m-%d', '%d-%m-%Y']) AS DATE) AS value_date,
  bedrag AS amount, 'EUR' AS currency_code,
  CASE WHEN iban <> '' AND iban <> '-450.0' THEN {sql_iban('iban')} END AS debtor_account_id,
  CASE WHEN iban <> '' AND iban <> '-450.0' THEN 'iban' END AS debtor_account_type, naam_van AS debtor_name,
  CASE WHEN upper(tegenrekening_iban) = 'ATM' THEN 'ATM' WHEN tegenrekening_iban <> ''
       THEN {sql_iban('tegenrekening_iban')} END AS creditor_account_id,
  CASE WHEN upper(tegenrekening_iban) = 'ATM' THEN 'atm' WHEN tegenrekening_iban <> '' THEN 'iban' END AS creditor_account_type,
  naam_naar AS creditor_name, CASE WHEN bedrag > 0 THEN 'credit' WHEN bedrag < 0 THEN 'debit' ELSE 'other' END AS transaction_type,
  'wire' AS payment_method, {sql_describe('omschrijving')} AS description, kenmerk AS reference_number,
  false AS is_cancelled, coalesce(is_storno = 'true', false) AS is_reversal
FROM fx_transactions""")

stage("st_canon_tx", f"""
SELECT *, CASE WHEN len(errs) > 0 THEN 'error' WHEN len(warns) > 0 THEN 'warning' ELSE 'valid' END AS validation_status,
  array_to_string(errs, '|') AS validation_errors, array_to_string(warns, '|') AS validation_warnings
FROM (SELECT *,
  (2 + CAST(coalesce(amount <> 0, false) AS BIGINT) + CAST(debtor_account_id IS NOT NULL AS BIGINT)
   + CAST(creditor_account_id IS NOT NULL AS BIGINT) + CAST(coalesce(description <> '', false) AS BIGINT)
   + CAST(reference_number IS NOT NULL AS BIGINT) + CAST(debtor_name IS NOT NULL AS BIGINT)
   + CAST(creditor_name IS NOT NULL AS BIGINT)) * 100 // 9 AS data_completeness_score,
  list_filter([
    CASE WHEN debtor_account_type = 'iban' AND NOT {sql_loose('debtor_account_id')} THEN 'Invalid debtor IBAN format: ' || debtor_account_id END,
    CASE WHEN creditor_account_type = 'iban' AND NOT {sql_loose('creditor_account_id')} THEN 'Invalid creditor IBAN format: ' || creditor_account_id END,
    CASE WHEN debtor_account_id IS NULL AND creditor_account_id IS NULL THEN 'Transaction must have at least one account (debtor or creditor)' END
  ], lambda x: x IS NOT NULL) AS errs,
  list_filter([
    CASE WHEN amount IS NULL THEN 'Amount is NULL - transaction may be incomplete' END,
    CASE WHEN amount = 0 THEN 'Zero amount transaction' END,
    CASE WHEN abs(amount) > 1000000 THEN 'Large amount: ' || CAST(amount AS VARCHAR) END,
    CASE WHEN creditor_account_type = 'atm' THEN 'ATM transaction without creditor IBAN' END,
    CASE WHEN transaction_datetime > {SQL_AS_OF} THEN 'Future transaction datetime: ' || strftime(transaction_datetime, '%Y-%m-%d %H:%M:%S') END
  ], lambda x: x IS NOT NULL) AS warns
 FROM st_tx_mapped) m""")

stage("st_comm_mapped", f"""
SELECT source_id AS source_system_id, call_id AS source_record_id, investigation_id, 'call' AS communication_type,
  date_trunc('second', timestamp) AS communication_datetime, duration_seconds, {sql_e164('caller')} AS originator_id,
  {sql_e164('callee')} AS recipient_id,
  CASE call_type WHEN 'incoming' THEN 'inbound' WHEN 'outgoing' THEN 'outbound' WHEN 'missed' THEN 'inbound'
    WHEN 'internal' THEN 'internal' ELSE 'unknown' END AS direction,
  CASE call_type WHEN 'missed' THEN 'missed' ELSE 'completed' END AS call_status, network_type AS connection_type,
  CAST(NULL AS VARCHAR) AS message_content, CAST(NULL AS VARCHAR) AS content_hash
FROM fx_calls
UNION ALL
SELECT source_id, message_id, investigation_id, 'sms', timestamp, NULL, {sql_e164('sender')}, {sql_e164('recipient')}, 'outbound', NULL, NULL,
  nullif(message_text, ''), CASE WHEN message_text <> '' THEN sha256(message_text) END
FROM fx_messages""")

stage("st_canon_comm", """
SELECT *, CASE WHEN len(errs) > 0 THEN 'error' WHEN len(warns) > 0 THEN 'warning' ELSE 'valid' END AS validation_status,
  array_to_string(errs, '|') AS validation_errors, array_to_string(warns, '|') AS validation_warnings
FROM (SELECT *,
  list_filter([
    CASE WHEN originator_id IS NULL THEN 'Missing required field: originator_id' END,
    CASE WHEN recipient_id IS NULL THEN 'Missing required field: recipient_id' END,
    CASE WHEN communication_type = 'call' AND duration_seconds < 0 THEN 'Negative duration: ' || CAST(duration_seconds AS VARCHAR) END
  ], lambda x: x IS NOT NULL) AS errs,
  list_filter([
    CASE WHEN communication_type = 'call' AND duration_seconds > 86400 THEN 'Very long call duration: ' || CAST(duration_seconds AS VARCHAR) || 's' END,
    CASE WHEN NOT coalesce(regexp_matches(originator_id, '^\\+[1-9][0-9]{1,14}$'), false) THEN 'Non-standard phone format: ' || coalesce(originator_id, 'None') END,
    CASE WHEN NOT coalesce(regexp_matches(recipient_id, '^\\+[1-9][0-9]{1,14}$'), false) THEN 'Non-standard phone format: ' || coalesce(recipient_id, 'None') END,
    CASE WHEN communication_type = 'sms' AND message_content IS NULL THEN 'Message records should have content' END
  ], lambda x: x IS NOT NULL) AS warns
 FROM st_comm_mapped) m""")


# ---- staging, dimensions, facts -------------------------------------------------------------


def stg_tx(d: Data) -> DataFrame:
    return models.stg_bank_transactions(canon_tx(d))


def stg_calls(d: Data) -> DataFrame:
    return models.stg_telecom_calls(canonical.validate_communications(canonical.map_calls(raw_calls(d))))


def stg_messages(d: Data) -> DataFrame:
    return models.stg_telecom_messages(canonical.validate_communications(canonical.map_messages(raw_messages(d))))


def dim_bank(d: Data) -> DataFrame:
    return models.dim_bank_account(stg_tx(d), AS_OF)


def dim_phone(d: Data) -> DataFrame:
    return models.dim_phone_number(stg_calls(d), stg_messages(d), AS_OF)


def fact_tx(d: Data) -> DataFrame:
    stg = kept(d, stg_tx(d), "stg-transactions")
    return models.fact_transaction(stg, models.dim_bank_account(stg, AS_OF))


def fact_calls(d: Data) -> DataFrame:
    stg = kept(d, stg_calls(d), "stg-calls")
    return models.fact_call(stg, models.dim_phone_number(stg, stg_messages(d), AS_OF))


def fact_messages(d: Data) -> DataFrame:
    stg = kept(d, stg_messages(d), "stg-messages")
    return models.fact_message(stg, models.dim_phone_number(stg_calls(d), stg, AS_OF))


KEY = "md5(source_system_id || '|' || source_record_id)"

stage("st_stg_tx", f"""
SELECT {KEY} AS transaction_id, investigation_id, source_system_id AS source_id, debtor_account_id AS iban_from,
  creditor_account_id AS iban_to, amount AS bedrag, CAST(transaction_datetime AS DATE) AS datum, posting_date, value_date,
  description AS omschrijving, debtor_name, creditor_name, transaction_type, payment_method, currency_code, validation_status,
  data_completeness_score
FROM st_canon_tx WHERE validation_status <> 'error'""")

stage("st_stg_calls", f"""
SELECT {KEY} AS call_id, investigation_id, source_system_id AS source_id, originator_id AS caller_number,
  recipient_id AS called_number, communication_datetime AS call_timestamp, CAST(communication_datetime AS DATE) AS call_date,
  strftime(communication_datetime, '%H:%M:%S') AS call_time, coalesce(duration_seconds, 0) AS duration_seconds,
  direction AS call_direction, call_status AS call_type, 'telecom_a' AS network_operator, connection_type, validation_status
FROM st_canon_comm WHERE communication_type = 'call' AND validation_status <> 'error'""")

stage("st_stg_msgs", f"""
SELECT {KEY} AS message_id, investigation_id, source_system_id AS source_id, originator_id AS sender_number,
  recipient_id AS recipient_number, communication_datetime AS message_timestamp, CAST(communication_datetime AS DATE) AS message_date,
  strftime(communication_datetime, '%H:%M:%S') AS message_time, message_content AS message_text, content_hash AS message_hash,
  direction AS message_direction, 'telecom_a' AS network_operator, validation_status
FROM st_canon_comm WHERE communication_type = 'sms' AND validation_status <> 'error'""")

stage("st_dim_bank", """
SELECT md5(iban) AS account_key, iban, land AS country_code, code AS bank_code,
  CASE land WHEN 'NL' THEN substr(iban, 9) ELSE substr(iban, 13) END AS account_number,
  coalesce(map_extract_value(MAP {'ABNA': 'ABN AMRO', 'INGB': 'ING Bank', 'RABO': 'Rabobank', 'TRIO': 'Triodos Bank',
    'SNSB': 'SNS Bank', 'ASNB': 'ASN Bank', 'RBRB': 'RegioBank', 'BUNQ': 'bunq', 'KNAB': 'Knab', 'REVOLT': 'Revolut'}, code),
    'Unknown Bank') AS bank_name,
  'checking' AS account_type, 'EUR' AS currency
FROM (SELECT iban, left(iban, 2) AS land,
        substr(iban, 5, CASE left(iban, 2) WHEN 'BE' THEN 3 WHEN 'DE' THEN 8 ELSE 4 END) AS code
      FROM (SELECT iban_from AS iban FROM st_stg_tx UNION SELECT iban_to FROM st_stg_tx) a
      WHERE regexp_matches(iban, '^[A-Z]{2}[0-9]{2}[A-Z0-9]{11,30}$')) b""")

stage("st_dim_phone", """
SELECT md5(n) AS phone_key, n AS phone_number,
  CASE WHEN starts_with(n, '+') THEN left(n, 3) ELSE '+31' END AS country_code,
  CASE WHEN starts_with(n, '+31') THEN substr(n, 4, 2) END AS area_code,
  CASE WHEN starts_with(n, '+31') THEN substr(n, 6) ELSE n END AS local_number,
  CASE WHEN regexp_matches(n, '^(\\+316|06)') THEN 'mobile' WHEN regexp_matches(n, '^(\\+31[1-57-9]|0[1-57-9])') THEN 'landline'
       WHEN regexp_matches(n, '^\\+[0-9]{2}[6-9]') THEN 'mobile' ELSE 'unknown' END AS phone_type,
  CASE WHEN regexp_matches(n, '^(\\+316|06)[0-2]') THEN 'KPN' WHEN regexp_matches(n, '^(\\+316|06)[3-5]') THEN 'Vodafone'
       WHEN regexp_matches(n, '^(\\+316|06)[6-8]') THEN 'T-Mobile' ELSE 'Unknown' END AS provider
FROM (SELECT DISTINCT CASE WHEN regexp_matches(p, '^06[0-9]{8}$') OR regexp_matches(p, '^0[1-57-9][0-9]{7,8}$') THEN '+31' || substr(p, 2)
               WHEN regexp_matches(p, '^\\+[0-9]+$') THEN p ELSE '+31' || p END AS n
      FROM (SELECT caller_number AS p FROM st_stg_calls UNION SELECT called_number FROM st_stg_calls
            UNION SELECT sender_number FROM st_stg_msgs UNION SELECT recipient_number FROM st_stg_msgs) u WHERE p IS NOT NULL) v
WHERE length(n) BETWEEN 10 AND 15 AND (regexp_matches(n, '^(06|\\+316)[0-9]{8}$')
  OR regexp_matches(n, '^(0[1-57-9]|\\+31[1-57-9])[0-9]{7,8}$') OR regexp_matches(n, '^\\+[0-9]{10,14}$'))""")


def sql_any(x: str, *words: str) -> str:
    return "(" + " OR ".join(f"contains(lower({x}), '{w}')" for w in words) + ")"


stage("st_fact_tx", f"""
SELECT s.transaction_id, s.investigation_id, s.source_id, s.datum AS transaction_date,
  CAST(s.datum AS TIMESTAMP) + INTERVAL 12 HOUR AS transaction_timestamp, s.datum AS posted_date, s.iban_from, s.iban_to,
  f.account_key AS account_key_from, t.account_key AS account_key_to, s.bedrag AS amount, 'EUR' AS currency,
  CASE WHEN s.bedrag > 0 THEN 'credit' WHEN s.bedrag < 0 THEN 'debit' ELSE 'neutral' END AS transaction_type,
  CASE WHEN {sql_any('s.omschrijving', 'salary', 'salaris')} THEN 'income' WHEN {sql_any('s.omschrijving', 'rent', 'huur')} THEN 'housing'
    WHEN {sql_any('s.omschrijving', 'groceries', 'albert heijn', 'jumbo', 'boodschappen')} THEN 'groceries'
    WHEN {sql_any('s.omschrijving', 'transfer', 'overschrijving')} THEN 'transfer'
    WHEN {sql_any('s.omschrijving', 'netflix', 'spotify', 'subscription')} THEN 'subscription'
    WHEN {sql_any('s.omschrijving', 'gas', 'water', 'electric', 'energie')} THEN 'utilities' ELSE 'other' END AS category,
  s.omschrijving AS description, split_part(s.omschrijving, ' ', -1) AS counter_party_name, CAST(NULL AS VARCHAR) AS reference,
  coalesce(abs(s.bedrag) > 10000, false) OR coalesce({sql_any('s.omschrijving', 'suspicious')}, false) AS is_suspicious,
  CAST(CASE WHEN abs(s.bedrag) > 50000 THEN 1 WHEN abs(s.bedrag) > 10000 THEN 0.75 WHEN abs(s.bedrag) > 5000 THEN 0.5
    WHEN abs(s.bedrag) > 1000 THEN 0.25 ELSE 0.1 END AS DOUBLE) AS risk_score, '' AS tags
FROM st_stg_tx s LEFT JOIN st_dim_bank f ON s.iban_from = f.iban LEFT JOIN st_dim_bank t ON s.iban_to = t.iban""")

stage("st_fact_call", """
SELECT s.call_id, s.investigation_id, s.source_id, s.call_timestamp AS call_date, s.call_date AS call_date_only, s.call_time,
  s.caller_number, s.called_number, f.phone_key AS caller_phone_key, t.phone_key AS called_phone_key,
  CAST(s.duration_seconds AS BIGINT) AS duration_seconds, round(s.duration_seconds / 6e1, 2) AS duration_minutes, s.call_type,
  CASE WHEN s.call_type = 'missed' THEN 'missed' WHEN s.call_direction IN ('inbound', 'outbound') THEN s.call_direction
    ELSE 'unknown' END AS call_direction,
  s.duration_seconds > 3600 OR s.duration_seconds < 1 AS is_suspicious,
  CAST(CASE WHEN s.duration_seconds > 7200 THEN 1 WHEN s.duration_seconds > 3600 THEN 0.75 WHEN s.duration_seconds > 1800 THEN 0.5
    WHEN hour(s.call_timestamp) <= 5 THEN 0.6 WHEN hour(s.call_timestamp) >= 22 THEN 0.4 ELSE 0.1 END AS DOUBLE) AS risk_score, '' AS tags
FROM st_stg_calls s LEFT JOIN st_dim_phone f ON s.caller_number = f.phone_number
LEFT JOIN st_dim_phone t ON s.called_number = t.phone_number""")

stage("st_fact_msg", f"""
SELECT s.message_id, s.investigation_id, s.source_id, s.message_timestamp AS message_date, s.message_date AS message_date_only,
  s.message_time, s.sender_number, s.recipient_number, f.phone_key AS sender_phone_key, t.phone_key AS recipient_phone_key,
  s.message_text, CAST(length(coalesce(s.message_text, '')) AS BIGINT) AS message_length,
  CASE WHEN trim(s.message_text) <> '' THEN CAST(len(string_split(trim(s.message_text), ' ')) AS BIGINT) END AS word_count,
  'sms' AS message_type, s.message_direction,
  coalesce({sql_any('s.message_text', 'urgent', 'password', 'bank', 'account', 'transfer')} OR length(s.message_text) > 500, false) AS is_suspicious,
  CAST(CASE WHEN {sql_any('s.message_text', 'password', 'pin')} THEN 1 WHEN {sql_any('s.message_text', 'bank', 'account')} THEN 0.75
    WHEN {sql_any('s.message_text', 'urgent', 'transfer')} THEN 0.6 WHEN length(s.message_text) > 500 THEN 0.5
    WHEN hour(s.message_timestamp) <= 5 THEN 0.4 ELSE 0.1 END AS DOUBLE) AS risk_score,
  CASE WHEN {sql_any('s.message_text', 'bank')} THEN 'banking' WHEN {sql_any('s.message_text', 'meet', 'appointment')} THEN 'meeting'
    WHEN {sql_any('s.message_text', 'urgent')} THEN 'urgent' ELSE '' END AS tags
FROM st_stg_msgs s LEFT JOIN st_dim_phone f ON s.sender_number = f.phone_number
LEFT JOIN st_dim_phone t ON s.recipient_number = t.phone_number""")


# ---- market, weather ------------------------------------------------------------------------


def candles(d: Data) -> DataFrame:
    return market.ohlcv_1min(d.fx_trades)


stage("st_candles", """
SELECT symbol, date_trunc('minute', event_time) AS minute, arg_min(price, trade_id) AS open_price, max(price) AS high_price,
  min(price) AS low_price, arg_max(price, trade_id) AS close_price, round(sum(quantity), 6) AS volume, count(*) AS trade_count
FROM fx_trades GROUP BY ALL""")


def silver(d: Data) -> DataFrame:
    """Observations after the quality gate: rows that fail it are labelled, not dropped."""
    ok = F.col("temperature") <= 45
    return weather.weather_silver(d.fx_observations).withColumn("data_quality", F.when(ok, "passed").otherwise("failed"))
