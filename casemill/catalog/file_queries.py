"""File types, paths, ids, masked views, claims, exchange events and written tables as queries."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F

from ..operators import governance, intake
from ..plans import market, weather
from ..session import scratch
from ..sources import readers, sinks
from ..sources.versions import read_version, write_version
from . import layers as L
from .registry import query, stage

SINCE = dt.datetime(2025, 1, 1, 1)


def sql_file_type() -> str:
    """Type by name, else by two keywords of the head, else unknown."""
    by_name = " ".join(f"WHEN regexp_matches(lower(file_name), '{p}') THEN '{t.name}'" for t in intake.FILE_TYPES for p in t.patterns)
    by_head = " ".join("WHEN " + " + ".join(f"CAST(contains(seen, '{k}') AS INT)" for k in t.keywords) + f" >= 2 THEN '{t.name}'" for t in intake.FILE_TYPES)
    return f"""SELECT file_name, CASE {by_name} END AS named, CASE {by_head} END AS guessed
FROM (SELECT *, CASE WHEN file_name LIKE '%.csv' THEN split_part(lower(head), chr(10), 1) WHEN file_name LIKE '%.json' THEN lower(head) END AS seen FROM fx_file_heads) h"""


stage("st_file_types", f"""
SELECT file_name, coalesce(named, guessed, 'unknown') AS file_type, CASE WHEN named IS NOT NULL THEN 'high' WHEN guessed IS NOT NULL THEN 'medium' ELSE 'none' END AS confidence
FROM ({sql_file_type()}) t""")


@query("file_types", """
SELECT *, CASE file_type WHEN 'bank_transactions' THEN 'bank_transaction_pipeline' WHEN 'call_records' THEN 'telecom_call_pipeline' WHEN 'sms_records' THEN 'telecom_call_pipeline'
    WHEN 'whatsapp_export' THEN 'whatsapp_processing_pipeline' WHEN 'forensic_metadata' THEN 'forensic_metadata_pipeline' WHEN 'social_media' THEN 'social_media_pipeline' END AS pipeline,
  CASE file_type WHEN 'bank_transactions' THEN 'transaction' WHEN 'call_records' THEN 'call_record' WHEN 'sms_records' THEN 'message' WHEN 'whatsapp_export' THEN 'message'
    WHEN 'forensic_metadata' THEN 'file_metadata' WHEN 'social_media' THEN 'social_media' END AS output_type
FROM st_file_types""")
def file_types(d):
    return intake.detect_file_types(d.fx_file_heads).select("file_name", "file_type", "confidence", "pipeline", "output_type")


@query("intake_triage", """
SELECT CASE file_type WHEN 'unknown' THEN 'skipped' ELSE 'detected' END AS status, file_type, count(*) AS count FROM st_file_types GROUP BY file_type""")
def intake_triage(d):
    return intake.intake_triage(d.fx_file_heads)


@query("discovered_files", f"""
SELECT path, size, created, split_part(path, '/', -1) AS file_name, CASE WHEN path LIKE '%investigations/%' THEN split_part(path, '/', 5) ELSE '{readers.DEFAULT_CASE}' END AS investigation_id,
  CASE WHEN path LIKE '%investigations/%' THEN split_part(path, '/', 6) ELSE 'unknown' END AS source_type
FROM fx_paths WHERE created > TIMESTAMP '2025-01-01 01:00:00'""")
def discovered_files(d):
    return readers.describe_paths(d.fx_paths.where(F.col("created") > F.lit(SINCE).cast("timestamp_ntz")))


@query("discovered_cases", "SELECT DISTINCT split_part(path, '/', 5) AS investigation_id FROM fx_paths WHERE path LIKE '%investigations/%'")
def discovered_cases(d):
    return readers.list_cases(d.fx_paths)


KIND = "CASE source_type WHEN 'bank' THEN {} WHEN 'telecom' THEN {} ELSE {} END"
FOLDERS, TABLES = KIND.format("'transactions'", "'call_records'", "'messages'"), KIND.format("'raw_transactions'", "'raw_calls'", "'raw_messages'")
PROCESSED = f"'store://processed/' || investigation_id || '/' || {FOLDERS} || '/' || file_name"


@query("backfill_route", f"SELECT {PROCESSED} AS path, {TABLES} AS target_table, source_id, investigation_id FROM fx_files")
def backfill_route(d):
    return intake.route_backfill(d.fx_files.select(F.expr(PROCESSED).alias("path")))


SOURCE_REQUESTS = "SELECT request_id, created_at, 'OND-2025-' || lpad(CAST(minute(created_at) + 1 AS STRING), 6, '0') AS investigation_id FROM fx_new_cases"


@query("source_ids", f"""
SELECT request_id, investigation_id, 'SRC-' || substr(investigation_id, 5) || '-' || lpad(CAST(n AS VARCHAR), CAST(greatest(3, length(CAST(n AS VARCHAR))) AS INTEGER), '0') AS source_id
FROM (SELECT request_id, r.investigation_id, row_number() OVER (PARTITION BY r.investigation_id ORDER BY created_at, request_id) + coalesce(highest, 0) AS n
      FROM ({SOURCE_REQUESTS}) r
        LEFT JOIN (SELECT investigation_id, max(CAST(split_part(source_id, '-', 4) AS BIGINT)) AS highest FROM fx_files GROUP BY investigation_id) f ON f.investigation_id = r.investigation_id) q""")
def source_ids(d):
    d.fx_new_cases.createOrReplaceTempView("fx_new_cases")
    return intake.assign_source_ids(d.spark.sql(SOURCE_REQUESTS), d.fx_files)


@query("raw_rows_kept", """
SELECT transaction_id AS record_id, 'transaction' AS kind, tegenrekening_iban AS other, CAST(bedrag AS DOUBLE) AS number FROM fx_transactions
UNION ALL SELECT call_id, 'call', callee, duration_seconds FROM fx_calls
UNION ALL SELECT message_id, 'sms', recipient, NULL FROM fx_messages""")
def raw_rows_kept(d):
    """Every canonical row leads back to the fields of its raw row."""
    raw = lambda f: F.get_json_object("source_raw_data", f"$.{f}")
    money = L.canon_tx(d).select(F.col("source_record_id").alias("record_id"), F.lit("transaction").alias("kind"), raw("tegenrekening_iban").alias("other"),
                                 raw("bedrag").cast("double").alias("number"))
    talk = L.canon_comm(d).select(F.col("source_record_id").alias("record_id"), F.col("communication_type").alias("kind"),
                                  F.coalesce(raw("callee"), raw("recipient")).alias("other"), raw("duration_seconds").cast("double").alias("number"))
    return money.unionByName(talk)


# ---- masked views, claims -------------------------------------------------------------------


@query("fact_transaction_masked", """
SELECT transaction_id, investigation_id, source_id, transaction_date, transaction_timestamp, posted_date, left(iban_from, 4) || '****' || right(iban_from, 4) AS iban_from_masked,
  left(iban_to, 4) || '****' || right(iban_to, 4) AS iban_to_masked, account_key_from, account_key_to, CAST(amount AS DOUBLE) AS amount, currency, transaction_type, category,
  length(description) AS description_length, CASE WHEN counter_party_name IS NOT NULL THEN '***REDACTED***' END AS counter_party_name_masked, reference, is_suspicious, risk_score, tags
FROM st_fact_tx""")
def fact_transaction_masked(d):
    return governance.fact_transaction_masked(L.fact_tx(d))


@query("fact_call_masked", """
SELECT call_id, investigation_id, source_id, call_date, call_date_only, call_time, '****' || right(caller_number, 4) AS caller_number_masked,
  '****' || right(called_number, 4) AS called_number_masked, caller_phone_key, called_phone_key, duration_seconds, duration_minutes, call_type, call_direction, is_suspicious, risk_score, tags
FROM st_fact_call""")
def fact_call_masked(d):
    return governance.fact_call_masked(L.fact_calls(d))


@query("token_claims", """
SELECT 'T-' || CAST(c_custkey AS VARCHAR) AS token_id, CASE WHEN good THEN CASE WHEN c_custkey % 5 = 0 THEN 'sub-' || CAST(c_custkey AS VARCHAR) ELSE c_name END END AS username,
  CASE WHEN good AND c_custkey % 4 <> 0 THEN c_name || '@example.org' END AS email, CASE WHEN good AND c_custkey % 3 <> 0 THEN 'investigator|data_analyst' ELSE '' END AS roles
FROM (SELECT *, c_custkey % 7 <> 0 AND c_custkey % 11 <> 0 AS good FROM customer) c""")
def token_claims(d):
    """Tokens of all customers; some have no user name, mail or roles, some bad characters or only two parts."""
    key, name = F.col("c_custkey"), F.col("c_name")
    claims = F.struct(F.when(key % 5 != 0, name).alias("preferred_username"), F.concat(F.lit("sub-"), key.cast("string")).alias("sub"),
                      F.when(key % 4 != 0, F.concat(name, F.lit("@example.org"))).alias("email"),
                      F.when(key % 3 != 0, F.struct(F.array(F.lit("investigator"), F.lit("data_analyst")).alias("roles"))).alias("realm_access"))
    body = F.translate(F.regexp_replace(F.base64(F.encode(F.to_json(claims), "UTF-8")), "[=\r\n]", ""), "+/", "-_")
    body = F.when(key % 7 == 0, F.concat(F.lit("*"), body)).otherwise(body)
    token = F.when(key % 11 == 0, F.concat(F.lit("h."), body)).otherwise(F.concat(F.lit("h."), body, F.lit(".s")))
    return governance.decode_claims(d.customer.select(F.concat(F.lit("T-"), key.cast("string")).alias("token_id"), token.alias("token")))


# ---- events, files and tables ---------------------------------------------------------------


@query("trade_events", "SELECT symbol, price, quantity, event_time, trade_id, is_buyer_maker, TIMESTAMP '2024-06-01 00:00:00' AS ingested_at FROM fx_trades")
def trade_events(d):
    at = F.unix_millis(F.col("event_time").cast("timestamp"))
    event = F.struct(F.col("symbol").alias("s"), F.col("price").cast("string").alias("p"), F.col("quantity").cast("string").alias("q"), at.alias("T"),
                     F.col("trade_id").alias("t"), F.col("is_buyer_maker").alias("m"))
    return market.reshape_trade_events(d.fx_trades.select(F.to_json(event).alias("value")), F.lit(dt.datetime(2024, 6, 1)).cast("timestamp_ntz"))


@query("exported_csv", """
SELECT transaction_id, investigation_id, CAST(bedrag AS DOUBLE) AS bedrag, (SELECT count(*) FROM fx_transactions) AS exported FROM fx_transactions""")
def exported_csv(d):
    """An export read back, with the row count that was taken while writing."""
    path = scratch(d.spark, "export")
    rows = sinks.export_csv(d.fx_transactions.select("transaction_id", "investigation_id", "omschrijving", "bedrag"), path)
    back = d.spark.read.options(header=True, escape='"').csv(path)
    return back.select("transaction_id", "investigation_id", F.col("bedrag").cast("double"), F.lit(rows).cast("bigint").alias("exported"))


@query("weather_versions", """
SELECT station_name, timestamp, event_month AS month, count(*) AS observations, count(*) FILTER (WHERE temperature <= 20) AS first_version
FROM (SELECT *, strftime(timestamp, '%Y-%m') AS event_month FROM fx_observations) o GROUP BY station_name, timestamp, event_month""")
def weather_versions(d):
    """Two versions of the weather table, partitioned by month: the newest is read, and the first by its name."""
    root = scratch(d.spark, "weather")
    rows = weather.weather_silver(d.fx_observations).withColumn("month", F.date_format("timestamp", "yyyy-MM"))
    write_version(rows.where("temperature <= 20"), root, "mild", ["month"])
    write_version(rows, root, "all", ["month"])
    newest, first = read_version(d.spark, root), read_version(d.spark, root, name="mild")
    both = newest.select("station_name", "timestamp", "month", F.lit(1).alias("new")).unionByName(
        first.select("station_name", "timestamp", "month", F.lit(0).alias("new")))
    return both.groupBy("station_name", "timestamp", "month").agg(F.sum("new").alias("observations"), F.count_if(F.col("new") == 0).alias("first_version"))
