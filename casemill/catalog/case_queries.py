"""Case analytics, register reports and searches."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F

from ..plans import cases
from .registry import query, stage

HOT_CASE = "OND-2025-000001"

stage("st_iban", """
SELECT investigation_id, iban, count(*) AS total_transactions, CAST(sum(CASE WHEN bedrag < 0 THEN bedrag ELSE 0 END) AS DOUBLE) AS total_debit,
  CAST(sum(CASE WHEN bedrag > 0 THEN bedrag ELSE 0 END) AS DOUBLE) AS total_credit, CAST(sum(bedrag) AS DOUBLE) AS net_amount,
  min(datum) AS first_transaction, max(datum) AS last_transaction, count(DISTINCT datum) AS active_days
FROM fx_transactions GROUP BY investigation_id, iban""")
stage("st_talk", """
SELECT investigation_id, caller, callee, count(*) AS call_count, CAST(sum(duration_seconds) AS BIGINT) AS total_duration_seconds,
  avg(duration_seconds) AS avg_duration_seconds, min(timestamp) AS first_call, max(timestamp) AS last_call
FROM fx_calls GROUP BY investigation_id, caller, callee""")
stage("st_chat", """
SELECT investigation_id, sender, recipient, count(*) AS message_count, min(timestamp) AS first_message, max(timestamp) AS last_message
FROM fx_messages GROUP BY investigation_id, sender, recipient""")
stage("st_day_rows", """
SELECT investigation_id, CAST(datum AS DATE) AS date, 't' AS kind, bedrag, 0 AS seconds FROM fx_transactions
UNION ALL SELECT investigation_id, CAST(timestamp AS DATE), 'c', 0, duration_seconds FROM fx_calls
UNION ALL SELECT investigation_id, CAST(timestamp AS DATE), 'm', 0, 0 FROM fx_messages""")
stage("st_days", """
SELECT investigation_id, date, count(*) FILTER (WHERE kind = 't') AS transaction_count, CAST(coalesce(sum(bedrag), 0) AS DOUBLE) AS total_amount,
  count(*) FILTER (WHERE kind = 'c') AS call_count, CAST(sum(seconds) AS BIGINT) AS total_call_duration,
  count(*) FILTER (WHERE kind = 'm') AS message_count
FROM st_day_rows GROUP BY investigation_id, date""")

query("iban_summary", "SELECT * FROM st_iban")(lambda d: cases.iban_summary(d.fx_transactions))
query("call_network", "SELECT * FROM st_talk")(lambda d: cases.call_network(d.fx_calls))
query("message_network", "SELECT * FROM st_chat")(lambda d: cases.message_network(d.fx_messages))


@query("daily_activity", "SELECT * FROM st_days")
def daily(d):
    return cases.daily_activity(d.fx_transactions, d.fx_calls, d.fx_messages)


STATS = """
SELECT investigation_id, name AS investigation_name, coalesce(total_transactions, 0) AS total_transactions,
  coalesce(total_transaction_amount, 0) AS total_transaction_amount, first_activity_date, last_activity_date, coalesce(active_days, 0) AS active_days,
  coalesce(unique_ibans, 0) AS unique_ibans, coalesce(total_calls, 0) AS total_calls, coalesce(total_call_duration_hours, 0) AS total_call_duration_hours,
  coalesce(unique_phone_numbers, 0) AS unique_phone_numbers, coalesce(total_messages, 0) AS total_messages,
  coalesce(unique_message_participants, 0) AS unique_message_participants
FROM fx_cases
LEFT JOIN (SELECT investigation_id, CAST(sum(transaction_count) AS BIGINT) AS total_transactions, round(sum(total_amount), 2) AS total_transaction_amount,
             min(date) AS first_activity_date, max(date) AS last_activity_date, count(DISTINCT date) AS active_days
           FROM st_days GROUP BY investigation_id) a USING (investigation_id)
LEFT JOIN (SELECT investigation_id, count(DISTINCT iban) AS unique_ibans FROM st_iban GROUP BY investigation_id) b USING (investigation_id)
LEFT JOIN (SELECT investigation_id, CAST(sum(call_count) AS BIGINT) AS total_calls, sum(total_duration_seconds) / 3600 AS total_call_duration_hours
           FROM st_talk GROUP BY investigation_id) c USING (investigation_id)
LEFT JOIN (SELECT investigation_id, count(DISTINCT v) AS unique_phone_numbers
           FROM (SELECT investigation_id, caller AS v FROM fx_calls UNION ALL SELECT investigation_id, callee FROM fx_calls) u GROUP BY 1) e USING (investigation_id)
LEFT JOIN (SELECT investigation_id, CAST(sum(message_count) AS BIGINT) AS total_messages FROM st_chat GROUP BY investigation_id) f USING (investigation_id)
LEFT JOIN (SELECT investigation_id, count(DISTINCT v) AS unique_message_participants
           FROM (SELECT investigation_id, sender AS v FROM fx_messages UNION ALL SELECT investigation_id, recipient FROM fx_messages) u GROUP BY 1) g USING (investigation_id)
WHERE status = 'active'"""
stage("st_stats", STATS)


def _stats(d):
    ibans, calls, messages = cases.iban_summary(d.fx_transactions), cases.call_network(d.fx_calls), cases.message_network(d.fx_messages)
    out = cases.case_stats(d.fx_cases, daily(d), ibans, calls, messages)
    return out.withColumn("total_transaction_amount", F.round(F.col("total_transaction_amount").cast("double"), 2))


query("case_stats", "SELECT * FROM st_stats")(_stats)


@query("case_analytics", """
SELECT investigation_id, first_activity_date, last_activity_date, coalesce(total_transactions, 0) AS total_transactions,
  coalesce(total_transaction_amount, 0) AS total_transaction_amount, coalesce(active_days, 0) AS active_days, coalesce(unique_ibans, 0) AS unique_ibans,
  coalesce(total_calls, 0) AS total_calls, coalesce(total_call_duration_hours, 0) AS total_call_duration_hours,
  coalesce(unique_phone_numbers, 0) AS unique_phone_numbers, coalesce(total_messages, 0) AS total_messages,
  coalesce(unique_message_participants, 0) AS unique_message_participants
FROM fx_cases LEFT JOIN st_stats USING (investigation_id)""")
def case_analytics(d):
    return cases.case_analytics(d.fx_cases, _stats(d))


@query("case_totals", """
SELECT investigation_id, total_ibans, total_transactions, total_debit, total_credit, net_amount, total_call_pairs, total_calls, total_duration_hours
FROM (SELECT investigation_id, count(*) AS total_ibans, CAST(sum(total_transactions) AS BIGINT) AS total_transactions, round(sum(total_debit), 2) AS total_debit,
        round(sum(total_credit), 2) AS total_credit, round(sum(net_amount), 2) AS net_amount FROM st_iban GROUP BY investigation_id) a
FULL JOIN (SELECT investigation_id, count(*) AS total_call_pairs, CAST(sum(call_count) AS BIGINT) AS total_calls,
             sum(total_duration_seconds) / 3600 AS total_duration_hours FROM st_talk GROUP BY investigation_id) b USING (investigation_id)""")
def case_totals(d):
    out = cases.case_totals(cases.iban_summary(d.fx_transactions), cases.call_network(d.fx_calls))
    return out.withColumns({c: F.round(F.col(c).cast("double"), 2) for c in ("total_debit", "total_credit", "net_amount")})


stage("st_file_sums", """
SELECT investigation_id, count(DISTINCT source_id) AS total_files, count(DISTINCT source_id) FILTER (WHERE processing_status = 'completed') AS processed_files,
  count(DISTINCT source_id) FILTER (WHERE processing_status = 'failed') AS failed_files, CAST(sum(file_size_bytes) AS BIGINT) AS total_storage_bytes,
  max(received_date) AS last_file_received FROM fx_files GROUP BY investigation_id""")


@query("case_summary", """
SELECT c.investigation_id, name, status, start_date, lead_investigator, coalesce(total_files, 0) AS total_files, coalesce(processed_files, 0) AS processed_files,
  coalesce(failed_files, 0) AS failed_files, total_storage_bytes, last_file_received, coalesce(total_records, 0) AS total_records
FROM fx_cases c LEFT JOIN st_file_sums USING (investigation_id)
LEFT JOIN (SELECT investigation_id, count(DISTINCT record_id) AS total_records FROM fx_records GROUP BY 1) r USING (investigation_id)""")
def case_summary(d):
    return cases.case_summary(d.fx_cases, d.fx_files, d.fx_records)


@query("case_record_counts", """
SELECT investigation_id, name, status, coalesce(t, 0) AS transaction_count, coalesce(k, 0) AS call_count, coalesce(m, 0) AS message_count FROM fx_cases
LEFT JOIN (SELECT investigation_id, count(DISTINCT transaction_id) AS t FROM fx_transactions GROUP BY 1) a USING (investigation_id)
LEFT JOIN (SELECT investigation_id, count(DISTINCT call_id) AS k FROM fx_calls GROUP BY 1) b USING (investigation_id)
LEFT JOIN (SELECT investigation_id, count(DISTINCT message_id) AS m FROM fx_messages GROUP BY 1) c USING (investigation_id)""")
def case_record_counts(d):
    return cases.case_record_counts(d.fx_cases, d.fx_transactions, d.fx_calls, d.fx_messages)


@query("processing_status_overview", """
SELECT investigation_id, source_type, processing_status, count(*) AS count, CAST(sum(file_size_bytes) AS BIGINT) AS total_bytes,
  avg(epoch(processing_completed_at - processing_started_at)) AS avg_processing_seconds
FROM fx_files GROUP BY investigation_id, source_type, processing_status""")
def processing_status_overview(d):
    return cases.processing_status_overview(d.fx_files)


@query("status_overview_map", """
SELECT source_type, string_agg(processing_status || ':' || CAST(n AS VARCHAR) || ':' || CAST(b AS VARCHAR), ',' ORDER BY processing_status) AS statuses
FROM (SELECT source_type, processing_status, count(*) AS n, CAST(sum(file_size_bytes) AS BIGINT) AS b FROM fx_files GROUP BY 1, 2) q GROUP BY source_type""")
def status_overview_map(d):
    told = F.transform(F.map_entries("statuses"), lambda e: F.concat_ws(":", e["key"], e["value"]["count"].cast("string"), e["value"]["total_bytes"].cast("string")))
    return cases.status_overview_map(d.fx_files).select("source_type", F.array_join(F.array_sort(told), ",").alias("statuses"))


@query("bank_file_summary", """
SELECT investigation_id, source_id, count(*) AS total_records, CAST(coalesce(sum(bedrag), 0) AS DOUBLE) AS total_amount, min(datum) AS first_date,
  max(datum) AS last_date, count(DISTINCT iban) AS unique_ibans FROM fx_transactions GROUP BY investigation_id, source_id""")
def bank_file_summary(d):
    return cases.bank_file_summary(d.fx_transactions)


@query("call_file_summary", """
SELECT investigation_id, source_id, count(*) AS total_calls, count(DISTINCT caller) AS unique_callers, count(DISTINCT callee) AS unique_callees,
  coalesce(sum(duration_seconds), 0) / 60 AS total_duration_minutes, min(timestamp) AS first_timestamp, max(timestamp) AS last_timestamp
FROM fx_calls GROUP BY investigation_id, source_id""")
def call_file_summary(d):
    return cases.call_file_summary(d.fx_calls)


@query("message_file_summary", """
SELECT investigation_id, source_id, count(*) AS total_messages, count(DISTINCT sender) AS unique_senders, count(DISTINCT recipient) AS unique_recipients,
  min(timestamp) AS first_timestamp, max(timestamp) AS last_timestamp FROM fx_messages GROUP BY investigation_id, source_id""")
def message_file_summary(d):
    return cases.message_file_summary(d.fx_messages)


@query("table_counts", """
SELECT 'transactions' AS table_name, count(*) AS row_count FROM fx_transactions UNION ALL SELECT 'calls', count(*) FROM fx_calls
UNION ALL SELECT 'messages', count(*) FROM fx_messages""")
def table_counts(d):
    return cases.table_counts({"transactions": d.fx_transactions, "calls": d.fx_calls, "messages": d.fx_messages})


@query("search_transactions", f"""
SELECT transaction_id, datum, CAST(bedrag AS DOUBLE) AS bedrag FROM fx_transactions
WHERE investigation_id = '{HOT_CASE}' AND datum BETWEEN DATE '1995-01-01' AND DATE '1997-12-31' AND abs(bedrag) >= 1000""")
def search_transactions(d):
    found = cases.search_transactions(d.fx_transactions, HOT_CASE, dt.date(1995, 1, 1), dt.date(1997, 12, 31), 1000)
    return found.select("transaction_id", "datum", "bedrag")


@query("search_calls", "SELECT call_id, caller, callee, timestamp FROM fx_calls WHERE caller = '0612345678' OR callee = '0612345678'")
def search_calls(d):
    return cases.search_calls(d.fx_calls, phone_number="0612345678").select("call_id", "caller", "callee", "timestamp")


@query("search_messages", f"SELECT message_id, sender, recipient, timestamp FROM fx_messages WHERE investigation_id = '{HOT_CASE}'")
def search_messages(d):
    return cases.search_messages(d.fx_messages, HOT_CASE).select("message_id", "sender", "recipient", "timestamp")


@query("case_list", "SELECT * FROM fx_cases WHERE status = 'active' AND start_date >= DATE '2025-02-01'")
def case_list(d):
    return cases.case_list(d.fx_cases, "active", start_date_from=dt.date(2025, 2, 1))


@query("file_list", "SELECT * FROM fx_files WHERE source_type = 'bank' AND processing_status = 'completed'")
def file_list(d):
    return cases.file_list(d.fx_files, source_type="bank", processing_status="completed")


query("pending_files", "SELECT * FROM fx_files WHERE processing_status = 'pending'")(lambda d: cases.pending_files(d.fx_files))
query("active_cases", "SELECT DISTINCT investigation_id FROM fx_cases WHERE status = 'active'")(lambda d: cases.active_cases(d.fx_cases))


@query("summary_search", "SELECT * FROM fx_records WHERE json_extract_string(summary, '$.kind') = 'odd'")
def summary_search(d):
    return cases.summary_search(d.fx_records, "kind", "odd")


@query("keyword_search", """
SELECT transaction_id, string_agg(w, '|' ORDER BY w) AS matched_terms
FROM (SELECT DISTINCT transaction_id, unnest(['salaris', 'netflix']) AS w, lower(omschrijving) AS o FROM fx_transactions) q
WHERE list_contains(regexp_split_to_array(o, '[^a-z0-9]+'), w) GROUP BY transaction_id""")
def keyword_search(d):
    return cases.keyword_search(d.fx_transactions, "de Salaris van Netflix", "transaction_id", "omschrijving")
