"""Access rules as queries."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F

from ..operators import governance
from .registry import query, stage

AS_OF = dt.datetime(2025, 11, 15, 12, 0)
USER = "jane.investigator"
MOMENT = "TIMESTAMP '2025-11-15 12:00:00'"

stage("st_grants", f"SELECT *, coalesce(expires_at > {MOMENT}, true) AS live FROM fx_grants")


@query("row_policy", f"""
SELECT transaction_id, investigation_id FROM fx_transactions
WHERE investigation_id IN (SELECT investigation_id FROM st_grants WHERE live AND user_id = '{USER}')""")
def row_policy(d):
    seen = governance.apply_row_policy(d.fx_transactions, "raw", ["investigator"], USER, d.fx_grants, AS_OF)
    return seen.select("transaction_id", "investigation_id")


@query("my_access", f"""
SELECT investigation_id, name, status, access_level, expires_at, live AS is_active FROM st_grants JOIN fx_cases USING (investigation_id) WHERE user_id = '{USER}'""")
def my_access(d):
    return governance.my_access(d.fx_cases, d.fx_grants, USER, AS_OF)


@query("access_matrix", f"""
SELECT user_id, g.investigation_id, name AS investigation_name, access_level,
  CASE WHEN expires_at IS NULL THEN 'Permanent' WHEN live THEN strftime(expires_at, '%Y-%m-%d') || ' (' || CAST(date_sub('day', {MOMENT}, expires_at) AS VARCHAR) || ' days left)'
       ELSE 'EXPIRED (' || strftime(expires_at, '%Y-%m-%d') || ')' END AS expires,
  CASE WHEN live THEN 'ACTIVE' ELSE 'EXPIRED' END AS status
FROM st_grants g LEFT JOIN fx_cases c ON g.investigation_id = c.investigation_id""")
def access_matrix(d):
    return governance.access_matrix(d.fx_cases, d.fx_grants, AS_OF)


@query("grant_counts", "SELECT count(*) FILTER (WHERE live) AS active, count(*) FILTER (WHERE NOT live) AS expired FROM st_grants")
def grant_counts(d):
    return governance.grant_counts(d.fx_grants, AS_OF)


stage("st_last_request", "SELECT * FROM fx_requests QUALIFY row_number() OVER (PARTITION BY user_id, investigation_id ORDER BY seq DESC) = 1")


@query("apply_grants", f"""
SELECT user_id, investigation_id, access_level, granted_by, granted_at, expires_at FROM fx_grants g
WHERE NOT EXISTS (SELECT 1 FROM st_last_request r WHERE r.user_id = g.user_id AND r.investigation_id = g.investigation_id)
UNION ALL
SELECT user_id, investigation_id, access_level, requested_by, {MOMENT}, {MOMENT} + INTERVAL 1 DAY * expires_days FROM st_last_request WHERE action = 'grant'""")
def apply_grants(d):
    return governance.apply_grants(d.fx_grants, d.fx_requests, AS_OF)


@query("grant_log", f"""
SELECT {MOMENT} AS event_time, requested_by AS user_name, CASE action WHEN 'grant' THEN 'GRANT_ACCESS' ELSE 'REVOKE_ACCESS' END AS event_type, investigation_id,
  CASE action WHEN 'grant' THEN 'Granted ' || access_level || ' access to user ' || user_id ELSE 'Revoked access from user ' || user_id END AS query_text, seq
FROM fx_requests""")
def grant_log(d):
    return governance.grant_log(d.fx_requests, AS_OF)
