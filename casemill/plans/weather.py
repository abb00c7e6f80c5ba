"""Weather observations, stations and towers near them."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window, functions as F

from ..functions.dates import from_seconds
from ..operators.keyed import newest_per_key, spread_join, upsert_latest
from ..operators.nearest import nearest
from .cases import page

# The stations of the source network.
STATIONS = (
    ("Amsterdam", 52.3676, 4.9041), ("Rotterdam", 51.9244, 4.4777), ("Den Haag", 52.0705, 4.3007),
    ("Utrecht", 52.0907, 5.1214), ("Eindhoven", 51.4416, 5.4697), ("Groningen", 53.2194, 6.5665),
    ("Maastricht", 50.8514, 5.6909),
)
TOWER_KEY = ["mcc", "net", "area", "cell"]
NEAR_KM = 10


def weather_silver(obs: DataFrame, quality: str = "passed") -> DataFrame:
    """Add the felt temperature, round the measures half-even, mark the quality."""
    felt = F.col("temperature") - (0.2 * F.col("wind_speed") + 0.01 * (100 - F.col("humidity")))
    rounded = {c: F.bround(c, 2) for c in ("temperature", "precipitation", "rain", "wind_speed", "feels_like_temp")}
    return (obs.withColumn("feels_like_temp", felt).withColumns(rounded)
            .withColumn("data_quality", F.lit(quality)))


def ingest_metrics(obs: DataFrame) -> DataFrame:
    return obs.agg(F.count("*").alias("records"), F.count_distinct("station_name").alias("stations"),
                   F.avg("temperature").alias("avg_temperature"))


def station_upsert(stations: DataFrame, obs: DataFrame) -> DataFrame:
    """Stations after a batch of observations: coordinates of the newest row win."""
    seen = newest_per_key(obs.select("station_name", "timestamp", "latitude", "longitude"),
                          ["station_name"], ["timestamp"]).drop("timestamp")
    return upsert_latest(stations.select("station_name", "latitude", "longitude"), seen, ["station_name"], [])


def observation_upsert(old: DataFrame, new: DataFrame) -> DataFrame:
    return upsert_latest(old, new, ["station_name", "timestamp"], ["ingestion_time"])


LATEST = ["station_name", "timestamp", "temperature", "humidity", "wind_speed", "feels_like_temp", "pressure",
          "data_quality"]


def latest_weather(obs: DataFrame) -> DataFrame:
    return newest_per_key(obs, ["station_name"], ["timestamp"]).select(*LATEST)


def hourly_trends(obs: DataFrame) -> DataFrame:
    hour = F.date_trunc("hour", "timestamp").cast("timestamp_ntz")
    return obs.groupBy(hour.alias("hour"), "station_name").agg(
        F.avg("temperature").alias("avg_temperature"), F.avg("humidity").alias("avg_humidity"),
        F.avg("wind_speed").alias("avg_wind_speed"), F.avg("feels_like_temp").alias("avg_feels_like"),
        F.count("*").alias("observation_count"))


def station_metrics(stations: DataFrame, obs: DataFrame) -> DataFrame:
    """Measures per station; observations are summed before the join, silent stations stay."""
    measured = obs.groupBy("station_name").agg(
        F.count("*").alias("total_observations"), F.max("timestamp").alias("last_observation"),
        F.avg("temperature").alias("avg_temperature"), F.min("temperature").alias("min_temperature"),
        F.max("temperature").alias("max_temperature"), F.avg("humidity").alias("avg_humidity"),
        F.avg("wind_speed").alias("avg_wind_speed"))
    return stations.select("station_name", "latitude", "longitude").join(
        measured, "station_name", "left").na.fill(0, subset=["total_observations"])


def station_list(obs: DataFrame) -> DataFrame:
    return obs.groupBy("station_name").agg(
        F.count("*").alias("observation_count"), F.max("timestamp").alias("last_observation")).orderBy("station_name")


def data_quality_summary(obs: DataFrame) -> DataFrame:
    """Share of each quality label; the window sees one row per label."""
    per = obs.where("data_quality IS NOT NULL").groupBy("data_quality").agg(
        F.count("*").alias("record_count"), F.min("timestamp").alias("first_seen"),
        F.max("timestamp").alias("last_seen"))
    every = F.sum("record_count").over(Window.partitionBy(F.lit(1)))
    return per.withColumn("percentage", F.col("record_count") * 100.0 / every.cast("double"))


def observation_search(obs: DataFrame, station: str | None = None, start_date=None, end_date=None,
                       limit: int | None = None, offset: int = 0, most: int | None = None) -> DataFrame:
    out = obs
    if station is not None:
        out = out.where(F.col("station_name").ilike(f"%{station}%"))
    if start_date is not None:
        out = out.where(F.col("timestamp") >= F.lit(start_date).cast("timestamp_ntz"))
    if end_date is not None:
        out = out.where(F.col("timestamp") <= F.lit(end_date).cast("timestamp_ntz"))
    ordered = out.orderBy(F.desc("timestamp"), "station_name", F.desc("ingestion_time"))
    return page(ordered, limit, offset, most).select(
        "station_name", "timestamp", "temperature", "humidity", "wind_speed", "precipitation", "rain",
        "wind_direction", "pressure", "feels_like_temp", "data_quality")


def observation_latest(obs: DataFrame, station: str | None = None) -> DataFrame:
    out = obs if station is None else obs.where(F.col("station_name").ilike(f"%{station}%"))
    return latest_weather(out)


# ---- towers ---------------------------------------------------------------------------------


def tower_clean(raw: DataFrame) -> DataFrame:
    """Typed towers inside the valid ranges, the newest row per cell id; zero means unknown."""
    def known(c, kind):
        return F.nullif(F.col(c), F.lit(0).cast(dict(raw.dtypes)[c])).cast(kind)

    base = raw.where(F.col("lat").between(-90, 90) & F.col("lon").between(-180, 180)).select(
        F.trim(F.lower("radio")).alias("radio"), *[known(c, "int").alias(c) for c in ("mcc", "net", "area")],
        known("cell", "bigint").alias("cell"), known("unit", "int").alias("unit"),
        known("lon", "double").alias("lon"), known("lat", "double").alias("lat"),
        known("range", "bigint").alias("range_m"), known("samples", "bigint").alias("samples"),
        F.coalesce("changeable", F.lit(0)).cast("int").alias("changeable"),
        from_seconds(F.col("created")).alias("created_ts"), from_seconds(F.col("updated")).alias("updated_ts"),
        F.col("averageSignal").cast("int").alias("average_signal"))
    return newest_per_key(base, [*TOWER_KEY, "unit"], ["updated_ts", "samples"])


def tower_search(clean: DataFrame, radio: str | None = None, mcc: int | None = None, bbox=None,
                 limit: int | None = None, offset: int = 0, most: int | None = None) -> DataFrame:
    """Busiest towers first; ``bbox`` is (min lon, min lat, max lon, max lat)."""
    out = clean
    if radio is not None:
        out = out.where(F.col("radio") == radio.strip().lower())
    if mcc is not None:
        out = out.where(F.col("mcc") == mcc)
    if bbox is not None:
        out = out.where(F.col("lon").between(bbox[0], bbox[2]) & F.col("lat").between(bbox[1], bbox[3]))
    ordered = out.orderBy(F.col("samples").desc_nulls_last(), *TOWER_KEY, "unit", "radio")
    return _tower_view(page(ordered, limit, offset, most))


def tower_by_cell(clean: DataFrame, cell: int) -> DataFrame:
    return _tower_view(clean.where(F.col("cell") == cell))


def _tower_view(clean: DataFrame) -> DataFrame:
    return clean.select("radio", *TOWER_KEY, "unit", "lon", "lat", F.col("range_m").alias("range"), "samples",
                        "changeable", F.col("created_ts").alias("created"), F.col("updated_ts").alias("updated"),
                        F.col("average_signal").alias("averageSignal"))


def tower_station(towers: DataFrame, stations: DataFrame) -> DataFrame:
    """The nearest station of each tower with a known position."""
    spots = stations.select("station_name", F.col("latitude").alias("lat"), F.col("longitude").alias("lon"))
    return nearest(towers.select(*TOWER_KEY, "radio", "lon", "lat"), spots, "station_name", TOWER_KEY)


def weather_near_towers(towers: DataFrame, stations: DataFrame, obs: DataFrame) -> DataFrame:
    """Each tower with the observations of its nearest station."""
    near = tower_station(towers, stations).select(
        "radio", *TOWER_KEY, F.col("lon").alias("tower_lon"), F.col("lat").alias("tower_lat"), "station_name",
        "distance_km")
    seen = obs.select("station_name", F.col("timestamp").alias("observation_time"), "temperature", "humidity",
                      "wind_speed", "wind_direction", "precipitation", "pressure", "feels_like_temp")
    return spread_join(seen, near, ["station_name"], "inner")


def weather_tower_proximity(towers: DataFrame, stations: DataFrame, obs: DataFrame,
                            max_km: float = NEAR_KM) -> DataFrame:
    """Towers close to a station that has reported, with its latest weather."""
    near = tower_station(towers, stations).where(F.col("distance_km") < max_km)
    last = latest_weather(obs).select("station_name", "temperature", "humidity", "wind_speed",
                                      F.col("timestamp").alias("weather_timestamp"))
    where = stations.select("station_name", F.col("latitude").alias("station_lat"),
                            F.col("longitude").alias("station_lon"))
    reported = last.join(where, "station_name")
    named = near.select("station_name", *[F.col(c).alias(f"tower_{c}") for c in ("radio", *TOWER_KEY)], "distance_km")
    return spread_join(named, reported, ["station_name"], "inner")
