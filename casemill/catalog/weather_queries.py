"""Weather observations, stations and towers."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..plans import weather
from .registry import query, stage

stage("st_silver", """
SELECT station_name, timestamp, round_even(temperature, 2) AS temperature, humidity, round_even(precipitation, 2) AS precipitation, round_even(rain, 2) AS rain,
  round_even(wind_speed, 2) AS wind_speed, wind_direction, pressure, latitude, longitude, ingestion_time,
  round_even(temperature - (0.2e0 * wind_speed + 0.01e0 * (100 - humidity)), 2) AS feels_like_temp, 'passed' AS data_quality FROM fx_observations""")


def _silver(d):
    return weather.weather_silver(d.fx_observations)


@query("ingest_metrics", """
SELECT count(*) AS records, count(DISTINCT station_name) AS stations, round(avg(temperature), 6) AS avg_temperature FROM fx_observations""")
def ingest_metrics(d):
    return weather.ingest_metrics(d.fx_observations).withColumn("avg_temperature", F.round("avg_temperature", 6))


@query("hourly_trends", """
SELECT date_trunc('hour', timestamp) AS hour, station_name, round(avg(temperature), 6) AS avg_temperature, round(avg(humidity), 6) AS avg_humidity,
  count(*) AS observation_count FROM fx_observations GROUP BY date_trunc('hour', timestamp), station_name""")
def hourly_trends(d):
    out = weather.hourly_trends(_silver(d))
    return out.select("hour", "station_name", F.round("avg_temperature", 6).alias("avg_temperature"), F.round("avg_humidity", 6).alias("avg_humidity"), "observation_count")


@query("station_metrics", """
SELECT s.station_name, s.latitude, s.longitude, count(o.station_name) AS total_observations, max(timestamp) AS last_observation,
  round(avg(temperature), 6) AS avg_temperature, min(temperature) AS min_temperature, max(temperature) AS max_temperature,
  round(avg(humidity), 6) AS avg_humidity, round(avg(wind_speed), 4) AS avg_wind_speed
FROM fx_stations s LEFT JOIN fx_observations o ON s.station_name = o.station_name GROUP BY s.station_name, s.latitude, s.longitude""")
def station_metrics(d):
    out = weather.station_metrics(d.fx_stations, d.fx_observations)
    return out.withColumns({"avg_temperature": F.round("avg_temperature", 6), "avg_humidity": F.round("avg_humidity", 6), "avg_wind_speed": F.round("avg_wind_speed", 4)})


@query("station_list", "SELECT station_name, count(*) AS observation_count, max(timestamp) AS last_observation FROM fx_observations GROUP BY station_name")
def station_list(d):
    return weather.station_list(d.fx_observations)


@query("data_quality_summary", """
SELECT q AS data_quality, count(*) AS record_count, min(timestamp) AS first_seen, max(timestamp) AS last_seen,
  count(*) * 100.0e0 / sum(count(*)) OVER () AS percentage
FROM (SELECT timestamp, CASE WHEN humidity > 90 THEN 'failed' ELSE 'passed' END AS q FROM fx_observations) t GROUP BY q""")
def data_quality_summary(d):
    marked = _silver(d).withColumn("data_quality", F.when(F.col("humidity") > 90, "failed").otherwise("passed"))
    return weather.data_quality_summary(marked)


@query("observation_search", """
SELECT station_name, timestamp, temperature, humidity FROM fx_observations WHERE station_name ILIKE '%dam%'""")
def observation_search(d):
    return weather.observation_search(_silver(d), "dam").select("station_name", "timestamp", "temperature", "humidity")


stage("st_tower_rows", """
SELECT lower(trim(radio)) AS radio, nullif(mcc, 0) AS mcc, nullif(net, 0) AS net, nullif(area, 0) AS area, nullif(cell, 0) AS cell, nullif(unit, 0) AS unit,
  nullif(lon, 0) AS lon, nullif(lat, 0) AS lat, nullif(range, 0) AS range_m, nullif(samples, 0) AS samples, updated
FROM fx_towers WHERE abs(lat) <= 90 AND abs(lon) <= 180""")


@query("tower_search", """
SELECT radio, mcc, net, area, cell, lon, lat, range_m AS range, samples
FROM (SELECT *, row_number() OVER (PARTITION BY mcc, net, area, cell, unit ORDER BY nullif(updated, 0) DESC NULLS LAST, samples DESC NULLS LAST) AS n
      FROM st_tower_rows) q WHERE n = 1 AND radio = 'lte' AND lon BETWEEN 3 AND 6 AND lat BETWEEN 51 AND 53""")
def tower_search(d):
    found = weather.tower_search(weather.tower_clean(d.fx_towers), "LTE", bbox=(3, 51, 6, 53))
    return found.select("radio", "mcc", "net", "area", "cell", "lon", "lat", "range", "samples")


stage("st_towers", """
SELECT * EXCLUDE (n, updated) FROM (SELECT *, row_number() OVER (PARTITION BY mcc, net, area, cell, unit ORDER BY nullif(updated, 0) DESC NULLS LAST, samples DESC NULLS LAST) AS n
  FROM st_tower_rows) q WHERE n = 1""")

# every tower with every station; of towers that share a key over units the nearer one counts
stage("st_tower_station", """
SELECT * EXCLUDE (n) FROM (
  SELECT *, row_number() OVER (PARTITION BY mcc, net, area, cell ORDER BY distance_km, station_name, radio, lon, lat) AS n
  FROM (SELECT radio, mcc, net, area, cell, lon, lat, station_name,
          round(6371 * acos(greatest(-1, least(1, cos(radians(lat)) * cos(radians(latitude)) * cos(radians(longitude - lon)) + sin(radians(lat)) * sin(radians(latitude))))), 6) AS distance_km
        FROM st_towers, fx_stations WHERE lat IS NOT NULL AND lon IS NOT NULL) d) r WHERE n = 1""")


def _km(df):
    return df.withColumn("distance_km", F.round("distance_km", 3))


@query("tower_station", "SELECT mcc, net, area, cell, radio, lon, lat, station_name, round(distance_km, 3) AS distance_km FROM st_tower_station")
def tower_station(d):
    return _km(weather.tower_station(weather.tower_clean(d.fx_towers), d.fx_stations))


@query("weather_tower_proximity", """
SELECT t.station_name, t.radio AS tower_radio, t.mcc AS tower_mcc, t.net AS tower_net, t.area AS tower_area, t.cell AS tower_cell, round(distance_km, 3) AS distance_km,
  temperature, humidity, wind_speed, timestamp AS weather_timestamp, latitude AS station_lat, longitude AS station_lon
FROM st_tower_station t JOIN (SELECT station_name, temperature, humidity, wind_speed, timestamp FROM st_silver
  QUALIFY row_number() OVER (PARTITION BY station_name ORDER BY timestamp DESC, ingestion_time DESC) = 1) o ON o.station_name = t.station_name
  JOIN fx_stations s ON s.station_name = t.station_name
WHERE distance_km < 10""")
def weather_tower_proximity(d):
    return _km(weather.weather_tower_proximity(weather.tower_clean(d.fx_towers), d.fx_stations, _silver(d)))


@query("weather_near_towers", """
SELECT mcc, net, area, cell, t.station_name, count(*) AS observations, round(min(distance_km), 3) AS distance_km, max(timestamp) AS last_time,
  round(sum(temperature), 6) AS temperatures, sum(humidity) AS humidities, round(max(pressure), 6) AS pressure, round(min(feels_like_temp), 2) AS feels_like
FROM st_tower_station t JOIN st_silver o ON o.station_name = t.station_name GROUP BY mcc, net, area, cell, t.station_name""")
def weather_near_towers(d):
    """Summed per tower, as a third of all observations is of one station."""
    seen = weather.weather_near_towers(weather.tower_clean(d.fx_towers), d.fx_stations, _silver(d))
    return seen.groupBy("mcc", "net", "area", "cell", "station_name").agg(
        F.count("*").alias("observations"), F.round(F.min("distance_km"), 3).alias("distance_km"), F.max("observation_time").alias("last_time"),
        F.round(F.sum("temperature"), 6).alias("temperatures"), F.sum("humidity").alias("humidities"), F.round(F.max("pressure"), 6).alias("pressure"),
        F.round(F.min("feels_like_temp"), 2).alias("feels_like"))


@query("tower_by_cell", """
SELECT radio, mcc, net, area, cell, unit, lon, lat, range_m AS range, samples FROM st_towers WHERE cell = 7""")
def tower_by_cell(d):
    return weather.tower_by_cell(weather.tower_clean(d.fx_towers), 7).select("radio", "mcc", "net", "area", "cell", "unit", "lon", "lat", "range", "samples")


@query("observation_latest", """
SELECT station_name, timestamp, temperature, humidity, wind_speed, feels_like_temp FROM st_silver WHERE station_name ILIKE '%dam%'
QUALIFY row_number() OVER (PARTITION BY station_name ORDER BY timestamp DESC, ingestion_time DESC) = 1""")
def observation_latest(d):
    return weather.observation_latest(_silver(d), "dam").select("station_name", "timestamp", "temperature", "humidity", "wind_speed", "feels_like_temp")
