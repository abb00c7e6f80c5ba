"""Data-quality rules as queries."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F

from ..operators import quality
from . import layers as L
from .registry import query, stage


def _failing(d, condition):
    return d.fx_transactions.where(F.coalesce(condition, F.lit(False))).select("transaction_id")


query("test_not_null", "SELECT transaction_id FROM fx_transactions WHERE omschrijving IS NULL")(lambda d: _failing(d, quality.not_null("omschrijving")))
query("test_accepted_values", "SELECT transaction_id FROM fx_transactions WHERE is_storno NOT IN ('true')")(
    lambda d: _failing(d, quality.accepted_values("is_storno", ["true"])))
query("test_positive", "SELECT transaction_id FROM fx_transactions WHERE bedrag < 0")(lambda d: _failing(d, quality.positive("bedrag")))
query("test_between", "SELECT transaction_id FROM fx_transactions WHERE bedrag NOT BETWEEN -1000 AND 1000")(lambda d: _failing(d, quality.between("bedrag", -1000, 1000)))
query("test_iban_format", "SELECT transaction_id FROM fx_transactions WHERE NOT regexp_matches(iban, '^[A-Z]{2}[0-9]{2}[A-Z0-9]{11,30}$')")(
    lambda d: _failing(d, quality.iban_format("iban")))
query("test_regex", "SELECT transaction_id FROM fx_transactions WHERE NOT regexp_matches(tijd, '^[0-2][0-9]:')")(lambda d: _failing(d, quality.regex("tijd", "^[0-2][0-9]:")))
query("test_unique", """
SELECT source_id, datum, count(*) AS n FROM fx_transactions GROUP BY source_id, datum HAVING count(*) > 1""")(
    lambda d: quality.duplicates(d.fx_transactions.select("source_id", "datum"), ["source_id", "datum"]))
query("test_relationships", """
SELECT call_id, caller FROM fx_calls WHERE caller IS NOT NULL AND NOT EXISTS (SELECT 1 FROM fx_messages m WHERE m.sender = fx_calls.caller)""")(
    lambda d: quality.orphans(d.fx_calls.select("call_id", "caller"), "caller", d.fx_messages, "sender"))

stage("st_weather_checks", """
SELECT 'temperature_range' AS "check", count(*) FILTER (WHERE NOT coalesce(temperature BETWEEN -30 AND 45, false)) AS failed_rows FROM fx_observations
UNION ALL SELECT 'humidity_range', count(*) FILTER (WHERE NOT coalesce(humidity BETWEEN 0 AND 100, false)) FROM fx_observations
UNION ALL SELECT 'wind_speed_positive', count(*) FILTER (WHERE NOT coalesce(wind_speed >= 0, false)) FROM fx_observations
UNION ALL SELECT 'precipitation_positive', count(*) FILTER (WHERE NOT coalesce(precipitation >= 0, false)) FROM fx_observations
UNION ALL SELECT 'no_null_temperature', count(*) FILTER (WHERE temperature IS NULL) FROM fx_observations
UNION ALL SELECT 'no_null_station', count(*) FILTER (WHERE station_name IS NULL) FROM fx_observations
UNION ALL SELECT 'valid_coordinates', count(*) FILTER (WHERE NOT coalesce(latitude BETWEEN 50.7 AND 53.6 AND longitude BETWEEN 3.3 AND 7.2, false)) FROM fx_observations""")


@query("weather_quality", """
SELECT "check", failed_rows, (SELECT count(*) FROM fx_observations) AS total, count(*) FILTER (WHERE failed_rows = 0) OVER () AS passed_checks,
  round(count(*) FILTER (WHERE failed_rows = 0) OVER () * 100.0e0 / 7, 2) AS quality_score, failed_rows = 0 AS passed FROM st_weather_checks""")
def weather_quality(d):
    return quality.weather_quality(d.fx_observations)


@query("mapping_quality", """
SELECT count(*) AS total, count(*) FILTER (WHERE validation_status = 'valid') AS valid, count(*) FILTER (WHERE validation_status = 'warning') AS warning,
  count(*) FILTER (WHERE validation_status = 'error') AS error,
  round(CAST(count(*) FILTER (WHERE validation_status IN ('valid', 'warning')) AS DOUBLE) * 100 / count(*), 2) AS validation_rate,
  round(CAST(count(*) FILTER (WHERE validation_status = 'valid') AS DOUBLE) * 100 / count(*), 2) AS quality_score FROM st_canon_tx""")
def mapping_quality(d):
    return quality.mapping_quality(L.canon_tx(d))


@query("source_freshness", """
SELECT station_name, max(ingestion_time) AS last_loaded, CAST(floor(date_sub('second', max(ingestion_time), TIMESTAMP '2025-01-01 00:00:00') / 3600) AS BIGINT) AS age_hours
FROM fx_observations GROUP BY station_name""")
def source_freshness(d):
    return quality.source_freshness(d.fx_observations, "station_name", "ingestion_time", dt.datetime(2025, 1, 1))
