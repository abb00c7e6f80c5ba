"""Intake state, identifiers, changes and increments."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F

from ..operators import governance, intake
from ..operators.keyed import change_log
from ..plans import cases
from ..session import scratch
from ..sources.readers import scan_mixed_csv
from . import layers as L
from .access import AS_OF, MOMENT
from .registry import query

CURSOR = dt.datetime(1996, 1, 1)


@query("case_changes", """
SELECT CASE WHEN o.investigation_id IS NULL THEN 'INSERT' WHEN n.investigation_id IS NULL THEN 'DELETE' ELSE 'UPDATE' END AS op,
  coalesce(o.investigation_id, n.investigation_id) AS investigation_id, o.status AS old_status, n.status AS new_status, o.name AS old_name, n.name AS new_name
FROM fx_cases o FULL JOIN fx_cases_later n ON o.investigation_id = n.investigation_id
WHERE o.investigation_id IS NULL OR n.investigation_id IS NULL OR o.status <> n.status""")
def case_changes(d):
    log = change_log(d.fx_cases, d.fx_cases_later, ["investigation_id"])
    told = {f"{side}_{c}": F.get_json_object(f"{side}_json", f"$.{c}") for c in ("status", "name") for side in ("old", "new")}
    return log.select("op", "investigation_id", *[c.alias(n) for n, c in told.items()])


@query("file_status", """
SELECT source_id, coalesce(max(status) FILTER (WHERE k = l AND k > r), 'pending') AS processing_status, max(event_time) FILTER (WHERE k = s AND k > r) AS started_at,
  max(event_time) FILTER (WHERE k = e AND k > r) AS completed_at, max(pipeline) FILTER (WHERE k = p) AS pipeline, max(error_message) FILTER (WHERE k = l AND k > r) AS error_message
FROM (SELECT *, coalesce(max(k) FILTER (WHERE status = 'retry' AND coalesce(known, '') <> 'completed') OVER w, 0) AS r, max(k) FILTER (WHERE status <> 'retry') OVER w AS l,
        max(k) FILTER (WHERE status = 'processing') OVER w AS s, max(k) FILTER (WHERE status IN ('completed', 'failed')) OVER w AS e, max(k) FILTER (WHERE pipeline IS NOT NULL) OVER w AS p
      FROM (SELECT *, row_number() OVER o AS k, last_value(CASE WHEN status <> 'retry' THEN status END IGNORE NULLS) OVER (PARTITION BY source_id ORDER BY event_time, seq ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS known
            FROM fx_status_events WINDOW o AS (PARTITION BY source_id ORDER BY event_time, seq)) n
      WINDOW w AS (PARTITION BY source_id)) f
GROUP BY source_id""")
def file_status(d):
    return intake.file_status(d.fx_status_events)


@query("case_ids", """
SELECT request_id, 'OND-' || CAST(y AS VARCHAR) || '-' || lpad(CAST(n AS VARCHAR), CAST(greatest(6, length(CAST(n AS VARCHAR))) AS INTEGER), '0') AS investigation_id
FROM (SELECT request_id, y, row_number() OVER (PARTITION BY y ORDER BY created_at, request_id) + coalesce(highest, 0) AS n
      FROM (SELECT *, year(created_at) AS y FROM fx_new_cases) r
        LEFT JOIN (SELECT CAST(split_part(investigation_id, '-', 2) AS BIGINT) AS of, max(CAST(split_part(investigation_id, '-', 3) AS BIGINT)) AS highest FROM fx_cases GROUP BY ALL) c ON of = y) q""")
def case_ids(d):
    return intake.assign_case_ids(d.fx_new_cases, d.fx_cases)


@query("transaction_source_summary", """
SELECT source_system_id, investigation_id, count(*) AS total_transactions, count(*) FILTER (WHERE validation_status = 'valid') AS valid_count,
  count(*) FILTER (WHERE validation_status = 'warning') AS warning_count, count(*) FILTER (WHERE validation_status = 'error') AS error_count,
  round(avg(data_completeness_score), 2) AS avg_completeness, min(transaction_datetime) AS first_transaction, max(transaction_datetime) AS last_transaction,
  CAST(sum(amount) AS DOUBLE) AS total_amount
FROM st_canon_tx GROUP BY source_system_id, investigation_id""")
def transaction_source_summary(d):
    return cases.transaction_source_summary(L.canon_tx(d))


@query("new_rows_since", """
SELECT count(*) AS new_count, max(transaction_datetime) AS latest_time FROM st_canon_tx
WHERE transaction_datetime > TIMESTAMP '1996-01-01 00:00:00' AND validation_status IN ('valid', 'warning')""")
def new_rows_since(d):
    return cases.new_rows_since(L.canon_tx(d), "transaction_datetime", CURSOR)


@query("audit_recent", f"""
SELECT {MOMENT} AS event_time, requested_by AS user_name, CASE action WHEN 'grant' THEN 'GRANT_ACCESS' ELSE 'REVOKE_ACCESS' END AS event_type, investigation_id, seq
FROM fx_requests ORDER BY seq DESC LIMIT 10""")
def audit_recent(d):
    return governance.audit_recent(governance.grant_log(d.fx_requests, AS_OF), "event_time", "seq").drop("query_text")


@query("layer_reconcile", """
SELECT 'transactions' AS layer, (SELECT count(*) FROM st_stg_tx) AS staging_count, (SELECT count(*) FROM st_fact_tx) AS fact_count, (SELECT count(*) FROM st_stg_tx) - (SELECT count(*) FROM st_fact_tx) AS new_count""")
def layer_reconcile(d):
    return cases.layer_reconcile({"transactions": (L.stg_tx(d), L.fact_tx(d))})


TEXT_COLUMNS = ("transaction_id", "investigation_id", "source_id", "iban", "tegenrekening_iban", "omschrijving", "kenmerk", "naam_van")


@query("mixed_layouts", f"""
SELECT {", ".join(f"nullif({c}, '') AS {c}" for c in TEXT_COLUMNS if c not in ("omschrijving", "naam_van"))}, omschrijving || chr(10) || '"q", ' || transaction_id AS omschrijving,
  CASE WHEN right(transaction_id, 1) NOT IN ('3', '6', '9') THEN naam_van END AS naam_van
FROM fx_transactions""")
def mixed_layouts(d):
    """Files in three layouts, with quoted line breaks: other orders and cases of names, and one without the payer's name. An empty field is null."""
    root, last = scratch(d.spark, "layouts"), F.right("transaction_id", F.lit(1))
    rows = d.fx_transactions.select(*TEXT_COLUMNS).withColumn("omschrijving", F.concat("omschrijving", F.lit('\n"q", '), "transaction_id"))
    third = last.isin("3", "6", "9")
    layouts = {
        "one": rows.where(last.isin("0", "1", "2")),
        "two": rows.where(~third & ~last.isin("0", "1", "2")).select(*[F.col(c).alias(c.upper()) for c in reversed(TEXT_COLUMNS)]),
        "three": rows.where(third).drop("naam_van"),
    }
    for name, df in layouts.items():
        df.write.options(header=True, escape='"', ignoreLeadingWhiteSpace=False, ignoreTrailingWhiteSpace=False).csv(f"{root}/{name}")
    return scan_mixed_csv(d.spark, [f"{root}/{name}" for name in layouts], needed=["transaction_id", "iban"]).select(*TEXT_COLUMNS)
