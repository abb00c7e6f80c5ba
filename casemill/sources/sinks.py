"""Writing tables, files and exports."""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation, SparkSession, functions as F

CASE_PARTS = ["investigation_id", "source_id"]
HOUR_PARTS = ["year", "month", "day", "hour"]


def write_parts(df: DataFrame, path: str, parts: list[str]) -> None:
    """Replace exactly the partitions present in ``df``, so a second run changes nothing.

    Rows are rebalanced by partition first: small ones end up in one file each,
    oversized ones are split over several tasks.
    """
    (df.hint("rebalance", *parts).write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
     .partitionBy(*parts).parquet(path))


def write_clean_parquet(df: DataFrame, path: str) -> None:
    write_parts(df, path, CASE_PARTS)


def write_weather_partitions(obs: DataFrame, path: str, at: str = "timestamp") -> None:
    pieces = {"year": "yyyy", "month": "MM", "day": "dd", "hour": "HH"}
    write_parts(obs.withColumns({name: F.date_format(at, form) for name, form in pieces.items()}), path, HOUR_PARTS)


def replace_table(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").option("partitionOverwriteMode", "static").parquet(path)


def append_table(df: DataFrame, path: str) -> None:
    df.write.mode("append").parquet(path)


def publish_serving(df: DataFrame, columns: list[str], path: str) -> None:
    replace_table(df.select(*columns), path)


def export_csv(df: DataFrame, path: str) -> int:
    """Write CSV with a header; the row count is taken along while writing."""
    seen = Observation("export")
    counted = df.observe(seen, F.count(F.lit(1)).alias("rows"))
    counted.write.mode("overwrite").option("header", True).option("escape", '"').csv(path)
    return seen.get["rows"]


def write_profile(profile: DataFrame, path: str) -> None:
    profile.write.mode("overwrite").json(path)


def backfill_tables(spark: SparkSession, root: str) -> DataFrame:
    """Processed files below ``root`` with target table, case and source by path."""
    from ..operators.intake import route_backfill
    from .readers import list_files

    files = list_files(spark, root).where(F.col("path").endswith(".parquet"))
    return route_backfill(files)
