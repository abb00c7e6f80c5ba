"""Inputs derived from the given tables. Every statement runs unchanged on Spark SQL and DuckDB.

A third of the rows falls on one case, one account, one symbol and one station.
"""

from __future__ import annotations

TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events", "documents",
          "embeddings", "pages", "benchmark", "labels", "conversations")


def _case(number: str) -> str:
    return f"'OND-2025-' || lpad(CAST({number} AS STRING), 6, '0')"


def _source(number: str, file: str) -> str:
    return f"'SRC-2025-' || lpad(CAST({number} AS STRING), 6, '0') || '-' || lpad(CAST({file} AS STRING), 3, '0')"


TX_CASE = "CASE WHEN o_orderkey % 3 = 0 THEN 1 ELSE o_custkey + 1 END"
CALL_CASE = "CASE WHEN event_id % 3 = 0 THEN 1 ELSE user_id + 1 END"
MSG_CASE = "CASE WHEN conv_id % 3 = 0 THEN 1 ELSE conv_id + 1 END"

INPUTS: dict[str, str] = {}

INPUTS["fx_transactions"] = f"""
SELECT 'TX-' || CAST(o_orderkey AS STRING) AS transaction_id, {_case(TX_CASE)} AS investigation_id,
  {_source(TX_CASE, "o_orderkey % 4 + 1")} AS source_id,
  CASE WHEN o_orderkey % 3 = 1 THEN 'NL91ABNA0417164300' WHEN o_custkey % 20 = 0 THEN NULL
       WHEN o_custkey % 20 = 1 THEN '-450.0' WHEN o_custkey % 20 = 2 THEN 'XX-BAD'
       ELSE 'NL' || CAST(o_custkey % 90 + 10 AS STRING) || CASE o_custkey % 4 WHEN 0 THEN 'abna' WHEN 1 THEN 'INGB'
            WHEN 2 THEN 'RABO' ELSE 'ZZZZ' END || lpad(CAST(o_custkey AS STRING), 10, '0') END AS iban,
  CASE o_orderkey % 25 WHEN 0 THEN 'atm' WHEN 1 THEN NULL WHEN 2 THEN 'be71 0961 2345 6769' WHEN 3 THEN ''
       ELSE 'DE' || CAST(o_orderkey % 90 + 10 AS STRING) || '37040044'
            || lpad(CAST((o_custkey * 7 + o_orderkey) % 50000 AS STRING), 10, '0') END AS tegenrekening_iban,
  CASE o_orderkey % 50 WHEN 7 THEN NULL WHEN 8 THEN CAST(0 AS DECIMAL(15,2)) WHEN 9 THEN CAST(2500000 AS DECIMAL(15,2))
       ELSE CAST((CASE WHEN o_orderstatus = 'F' THEN -1e0 ELSE 1e0 END)
                 * CAST(CAST(round(o_totalprice * 1e2) AS BIGINT) % 6000000 AS DOUBLE) / 1e2 AS DECIMAL(15,2)) END AS bedrag,
  CAST(o_orderdate AS DATE) AS datum,
  CASE o_orderkey % 9 WHEN 0 THEN 'Betaling:  Salaris maart' WHEN 1 THEN 'Huur woning' WHEN 2 THEN 'Albert Heijn 1234'
       WHEN 3 THEN 'Transfer: Overschrijving J. Jansen' WHEN 4 THEN 'NETFLIX subscription' WHEN 5 THEN 'Energie nota'
       WHEN 6 THEN ' Suspicious   payment' WHEN 7 THEN NULL ELSE 'Overig' END AS omschrijving,
  CASE o_orderkey % 6 WHEN 0 THEN '09:30:15' WHEN 1 THEN '25:00:00' WHEN 2 THEN '23:59' ELSE NULL END AS tijd,
  CASE o_orderkey % 5 WHEN 0 THEN lpad(CAST(o_orderkey % 28 + 1 AS STRING), 2, '0') || '-03-2024'
       WHEN 1 THEN 'onbekend' ELSE NULL END AS valutadatum,
  CASE WHEN o_orderkey % 4 = 0 THEN 'KM' || CAST(o_orderkey AS STRING) END AS kenmerk,
  CASE WHEN o_custkey % 2 = 0 THEN c_name END AS naam_van, 'Winkel ' || CAST(o_orderkey % 30 AS STRING) AS naam_naar,
  CASE o_orderkey % 11 WHEN 0 THEN 'true' WHEN 1 THEN 'false' END AS is_storno
FROM orders JOIN customer ON o_custkey = c_custkey"""

INPUTS["fx_calls"] = f"""
SELECT 'CALL-' || CAST(event_id AS STRING) AS call_id, {_case(CALL_CASE)} AS investigation_id,
  {_source(CALL_CASE, "event_id % 2 + 1")} AS source_id,
  CASE WHEN event_id % 3 = 1 THEN '0612345678' WHEN event_id % 41 = 0 THEN ''
       ELSE '06' || lpad(CAST((user_id * 7919) % 100000000 AS STRING), 8, '0') END AS caller,
  CASE WHEN event_id % 29 = 0 THEN '020-7654321' WHEN event_id % 31 = 0 THEN '(+49) 30 1234567' ELSE
       '+31 6-' || lpad(CAST((event_id % 400 * 104729) % 100000000 AS STRING), 8, '0') END AS callee,
  ts AS timestamp,
  CASE WHEN event_id % 37 = 0 THEN -5 WHEN event_id % 43 = 0 THEN 90000
       ELSE CAST(floor(value * 4e1) AS INT) END AS duration_seconds,
  CASE event_type WHEN 'click' THEN 'incoming' WHEN 'view' THEN 'outgoing' WHEN 'error' THEN 'missed'
       WHEN 'signup' THEN 'internal' ELSE 'other' END AS call_type,
  CASE WHEN event_id % 2 = 0 THEN '4G' ELSE '5G' END AS network_type
FROM events"""

INPUTS["fx_messages"] = f"""
SELECT 'MSG-' || CAST(conv_id AS STRING) || '-' || CAST(turn AS STRING) AS message_id, {_case(MSG_CASE)} AS investigation_id,
  {_source(MSG_CASE, "9")} AS source_id,
  CASE role WHEN 'user' THEN '0612' ELSE '0634' END || lpad(CAST(conv_id AS STRING), 6, '0') AS sender,
  CASE role WHEN 'user' THEN '0634' ELSE '0612' END || lpad(CAST(conv_id AS STRING), 6, '0') AS recipient,
  TIMESTAMP '2024-01-01 00:00:00' + INTERVAL '1' MINUTE * (conv_id * 97 + turn) AS timestamp,
  CASE WHEN conv_id % 11 = 4 THEN '' WHEN conv_id % 7 = 3 THEN 'URGENT bank pin ' || text
       WHEN conv_id % 7 = 5 THEN 'Meet me bij de afspraak ' || text ELSE text END AS message_text
FROM conversations"""

INPUTS["fx_trades"] = """
SELECT CASE WHEN event_id % 3 = 0 THEN 'BTCUSDT' WHEN event_type = 'click' THEN 'ETHUSDT' WHEN event_type = 'view' THEN 'SOLUSDT'
            ELSE 'BNBUSDT' END AS symbol,
  value + 1e2 AS price, CAST(event_id % 50 + 1 AS DOUBLE) / 1e1 AS quantity,
  TIMESTAMP '2024-01-01 00:00:00' + INTERVAL '1' SECOND * (event_id * 5) AS event_time, event_id AS trade_id,
  event_id % 2 = 0 AS is_buyer_maker,
  TIMESTAMP '2024-01-01 00:00:02' + INTERVAL '1' SECOND * (event_id * 5) AS ingested_at
FROM events"""

INPUTS["fx_towers"] = """
SELECT CASE c_custkey % 4 WHEN 0 THEN ' GSM ' WHEN 1 THEN 'UMTS' WHEN 2 THEN 'LTE' ELSE '5G' END AS radio, 204 AS mcc,
  CAST(floor(c_custkey / 30) AS INT) % 4 AS net, CAST(floor(c_custkey / 3) AS INT) % 50 AS area,
  CAST(floor(c_custkey / 3) AS BIGINT) AS cell, 0 AS unit,
  CASE WHEN c_custkey % 31 = 0 THEN 0e0 ELSE 3.3e0 + CAST((c_custkey * 13) % 390 AS DOUBLE) / 1e2 END AS lon,
  CASE WHEN c_custkey % 37 = 0 THEN 9.5e1 ELSE 5.07e1 + CAST(c_custkey % 290 AS DOUBLE) / 1e2 END AS lat,
  CAST(c_custkey % 5 * 500 AS BIGINT) AS range, CAST(c_custkey % 40 AS BIGINT) AS samples, 1 AS changeable,
  CAST(1600000000 + c_custkey * 1000 AS BIGINT) AS created,
  CASE WHEN c_custkey % 11 = 0 THEN CAST(0 AS BIGINT) ELSE CAST(1650000000 + c_custkey * 1000 AS BIGINT) END AS updated,
  CAST(0 AS INT) AS averageSignal
FROM customer"""

INPUTS["fx_stations"] = """
SELECT station_name, latitude, longitude FROM (VALUES ('Amsterdam', 52.3676e0, 4.9041e0), ('Rotterdam', 51.9244e0, 4.4777e0),
  ('Den Haag', 52.0705e0, 4.3007e0), ('Utrecht', 52.0907e0, 5.1214e0), ('Eindhoven', 51.4416e0, 5.4697e0),
  ('Groningen', 53.2194e0, 6.5665e0), ('Maastricht', 50.8514e0, 5.6909e0)) AS t(station_name, latitude, longitude)
UNION ALL
SELECT 'Post-' || CAST(s_suppkey AS STRING), 5.075e1 + CAST((s_suppkey * 37) % 280 AS DOUBLE) / 1e2,
  3.351e0 + CAST((s_suppkey * 53) % 380 AS DOUBLE) / 1e2
FROM supplier"""

INPUTS["fx_observations"] = """
SELECT CASE WHEN event_id % 3 = 0 THEN 'Amsterdam' WHEN user_id % 7 = 0 THEN 'Rotterdam' WHEN user_id % 7 = 1 THEN 'Den Haag'
            WHEN user_id % 7 = 2 THEN 'Utrecht' WHEN user_id % 7 = 3 THEN 'Groningen'
            ELSE 'Post-' || CAST(user_id % 10 AS STRING) END AS station_name,
  date_trunc('minute', ts) AS timestamp, CAST(event_id % 60 - 10 AS DOUBLE) + 0.25e0 AS temperature,
  CAST(event_id % 101 AS INT) AS humidity, CAST(event_id % 7 AS DOUBLE) / 1e1 AS precipitation,
  CAST(event_id % 5 AS DOUBLE) / 1e1 AS rain, value / 1e1 AS wind_speed, CAST(event_id % 360 AS INT) AS wind_direction,
  1e3 + CAST(event_id % 40 AS DOUBLE) AS pressure, 5.1e1 + CAST(event_id % 250 AS DOUBLE) / 1e2 AS latitude,
  3.5e0 + CAST(event_id % 300 AS DOUBLE) / 1e2 AS longitude, ts AS ingestion_time
FROM events"""

INPUTS["fx_cases"] = f"""
SELECT {_case("c_custkey + 1")} AS investigation_id,
  CASE WHEN c_custkey % 53 = 7 THEN 'X' ELSE 'Operatie ' || c_name END AS name,
  CASE c_custkey % 5 WHEN 4 THEN 'closed' WHEN 3 THEN 'archived' ELSE 'active' END AS status,
  DATE '2025-01-01' + CAST(c_custkey % 300 AS INT) AS start_date,
  CASE WHEN c_custkey % 5 > 2 THEN DATE '2025-06-01' + CAST(c_custkey % 50 AS INT) END AS end_date,
  'lead-' || CAST(c_nationkey AS STRING) AS lead_investigator,
  TIMESTAMP '2025-01-01 00:00:00' + INTERVAL '1' MINUTE * (c_custkey * 7) AS created_at
FROM customer"""

INPUTS["fx_grants"] = f"""
SELECT CASE WHEN c_custkey % 3 = 0 THEN 'jane.investigator' ELSE 'user-' || CAST(c_nationkey AS STRING) END AS user_id,
  {_case("c_custkey + 1")} AS investigation_id, CASE WHEN c_custkey % 4 = 0 THEN 'write' ELSE 'read' END AS access_level,
  'admin' AS granted_by, TIMESTAMP '2025-01-01 00:00:00' AS granted_at,
  CASE c_custkey % 5 WHEN 0 THEN CAST(NULL AS TIMESTAMP) WHEN 1 THEN TIMESTAMP '2025-11-30 08:00:00'
       WHEN 2 THEN TIMESTAMP '2025-01-01 00:00:00'
       ELSE TIMESTAMP '2025-11-01 00:00:00' + INTERVAL '1' HOUR * (c_custkey % 900) END AS expires_at
FROM customer"""

INPUTS["fx_files"] = """
SELECT investigation_id, source_id, CASE n % 3 WHEN 0 THEN 'bank' WHEN 1 THEN 'telecom' ELSE 'sms' END AS source_type,
  CASE n % 4 WHEN 0 THEN 'failed' WHEN 1 THEN 'pending' ELSE 'completed' END AS processing_status,
  source_id || CASE n % 3 WHEN 0 THEN '_transacties.csv' WHEN 1 THEN '_calls.csv' ELSE '_sms.csv' END AS file_name,
  CAST(n * 1024 AS BIGINT) AS file_size_bytes, DATE '2025-01-01' + CAST(n % 200 AS INT) AS received_date,
  TIMESTAMP '2025-01-02 00:00:00' AS processing_started_at,
  CASE WHEN n % 4 > 1 THEN TIMESTAMP '2025-01-02 00:00:00' + INTERVAL '1' SECOND * n END AS processing_completed_at
FROM (SELECT investigation_id, source_id, CAST(sum(length(transaction_id)) AS BIGINT) AS n
      FROM fx_transactions GROUP BY investigation_id, source_id) g"""

INPUTS["fx_records"] = """
SELECT source_id || '/' || CAST(datum AS STRING) AS record_id, investigation_id, source_id, datum AS record_date,
  '{"total_records":' || CAST(n AS STRING) || ',"kind":"' || CASE n % 2 WHEN 0 THEN 'even' ELSE 'odd' END || '"}' AS summary
FROM (SELECT investigation_id, source_id, datum, count(*) AS n FROM fx_transactions GROUP BY investigation_id, source_id, datum) g"""

INPUTS["fx_file_heads"] = """
SELECT CASE doc_id % 12 WHEN 0 THEN 'bank_a_transactions_' WHEN 1 THEN 'mutaties_' WHEN 2 THEN 'BelGegevens_' WHEN 3 THEN 'sms_export_'
         WHEN 4 THEN 'unknown_' WHEN 5 THEN 'data_' WHEN 6 THEN 'whatsapp_chat_' WHEN 7 THEN 'disk_metadata_' WHEN 8 THEN 'dump_'
         WHEN 9 THEN 'chat-export-' WHEN 10 THEN 'dump_' ELSE 'notes_' END || CAST(doc_id AS STRING)
    || CASE WHEN doc_id % 12 IN (6, 9) THEN '.txt' WHEN doc_id % 12 IN (7, 8, 10) THEN '.json'
            WHEN doc_id % 12 = 11 THEN '.pdf' ELSE '.csv' END AS file_name,
  CASE doc_id % 12 WHEN 4 THEN 'Caller;Callee;Duration;IMEI' || chr(10) || text
         WHEN 8 THEN '{"posts":[],"friends":[],"body":"' || text || '"}' ELSE text END AS head
FROM documents"""

INPUTS["fx_status_events"] = """
SELECT 'SRC-' || CASE WHEN o_orderkey % 3 = 0 THEN 'HOT' ELSE CAST(o_custkey AS STRING) END AS source_id, o_orderkey AS seq,
  o_orderdate AS event_time,
  CASE o_orderkey % 7 WHEN 0 THEN 'retry' WHEN 1 THEN 'processing' WHEN 2 THEN 'completed' WHEN 3 THEN 'failed' WHEN 4 THEN 'retry'
       WHEN 5 THEN 'processing' ELSE 'failed' END AS status,
  CASE WHEN o_orderkey % 4 = 0 THEN 'pipeline_' || CAST(o_orderkey % 3 AS STRING) END AS pipeline,
  CASE WHEN o_orderkey % 7 = 3 THEN 'error ' || CAST(o_orderkey AS STRING) END AS error_message
FROM orders"""

INPUTS["fx_requests"] = f"""
SELECT CASE WHEN event_id % 3 = 0 THEN 'jane.investigator' ELSE 'user-' || CAST(user_id % 25 AS STRING) END AS user_id,
  {_case("event_id % 400 + 1")} AS investigation_id, CASE WHEN event_type = 'error' THEN 'revoke' ELSE 'grant' END AS action,
  CASE event_type WHEN 'click' THEN 'write' ELSE 'read' END AS access_level,
  CASE WHEN event_id % 2 = 0 THEN CAST(event_id % 90 AS INT) END AS expires_days,
  'admin-' || CAST(event_id % 3 AS STRING) AS requested_by, event_id AS seq
FROM events"""

INPUTS["fx_new_cases"] = """
SELECT 'REQ-' || CAST(o_orderkey AS STRING) AS request_id,
  CASE WHEN o_orderkey % 3 = 0 THEN TIMESTAMP '2025-03-01 00:00:00' + INTERVAL '1' MINUTE * (o_orderkey % 50000)
       ELSE o_orderdate END AS created_at
FROM orders"""

INPUTS["fx_cases_later"] = f"""
SELECT investigation_id, name, CASE WHEN start_date < DATE '2025-02-01' THEN 'closed' ELSE status END AS status, start_date,
  end_date, lead_investigator, created_at
FROM fx_cases WHERE start_date <> DATE '2025-01-03'
UNION ALL
SELECT 'OND-2026-' || lpad(CAST(s_suppkey + 1 AS STRING), 6, '0'), s_name, 'active', DATE '2026-01-01', CAST(NULL AS DATE),
  'lead-' || CAST(s_nationkey AS STRING), TIMESTAMP '2026-01-01 00:00:00'
FROM supplier"""

# Cleaned rows as they leave intake: separators gone, plus signs as 00.
INPUTS["fx_paths"] = """
SELECT 'store://files/' || CASE page_id % 5 WHEN 4 THEN 'inbox/' ELSE 'investigations/OND-2025-' || lpad(CAST(page_id % 40 AS STRING), 6, '0')
    || '/' || CASE page_id % 3 WHEN 0 THEN 'bank' WHEN 1 THEN 'telecom' ELSE 'forensic' END || '/' END
    || 'file-' || CAST(page_id AS STRING) || '.csv' AS path,
  CAST(length(html) AS BIGINT) AS size, TIMESTAMP '2025-01-01 00:00:00' + INTERVAL '1' MINUTE * page_id AS created
FROM pages"""

INPUTS["fx_persons"] = """
SELECT 'P-' || CAST(c_custkey AS STRING) AS person_id,
  CASE c_custkey % 7 WHEN 0 THEN 'legal' WHEN 1 THEN 'unknown' WHEN 2 THEN 'company' ELSE 'natural' END AS person_type,
  CASE c_custkey % 9 WHEN 0 THEN 'iban' WHEN 1 THEN 'msisdn' WHEN 2 THEN 'visa' WHEN 3 THEN NULL ELSE 'email' END AS identifier_type,
  CASE c_custkey % 5 WHEN 0 THEN 'suspect' WHEN 1 THEN 'victim' WHEN 2 THEN 'neighbour' ELSE 'related' END AS person_role,
  CASE c_custkey % 4 WHEN 0 THEN 'high' WHEN 1 THEN 'severe' WHEN 2 THEN NULL ELSE 'low' END AS risk_level,
  CAST(c_custkey % 120 AS DOUBLE) / 1e2 AS confidence_score, CAST(c_custkey % 110 AS INT) - 3 AS data_completeness_pct
FROM customer"""
