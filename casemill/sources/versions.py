"""Tables kept in whole versions, each named by a manifest that is committed last.

A version is a folder of Parquet files of its own. The manifest, one small file below ``versions``, is written after
all data; a write that dies leaves files no manifest names, which no reader sees, and the version before stays the
newest. Readers see a version whole or not at all, and old ones by name or number. Two writers must not commit to one
table at the same time: they would take the same number, and a reader of that number gets an error.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, Observation, SparkSession, functions as F
from pyspark.errors import AnalysisException

MANIFEST = "version bigint, name string, folder string, parts array<string>, rows bigint, committed timestamp_ntz"


class NoSuchVersion(LookupError):
    pass


def list_versions(spark: SparkSession, root: str) -> DataFrame:
    """Committed versions: version, name, folder, parts, rows, committed. No row where nothing was committed."""
    try:
        return spark.read.schema(MANIFEST).json(f"{root}/versions")
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], MANIFEST)


def write_version(df: DataFrame, root: str, name: str | None = None, parts: list[str] | None = None) -> int:
    """Write ``df`` as the next version and return its number; rows are counted while they are written.

    With ``parts`` the version is partitioned by these columns; large partitions are split over several tasks,
    small ones become one file. A name, by default the number, stands for one version only.
    """
    spark, parts = df.sparkSession, list(parts or ())
    known = list_versions(spark, root).agg(F.max("version"), F.count_if(F.col("name") == F.lit(name))).first()
    if name is not None and known[1]:
        raise ValueError(f"there is a version named {name}")
    number, folder = (known[0] or 0) + 1, f"data/{uuid.uuid4().hex}"
    seen = Observation(f"version-{number}-{uuid.uuid4().hex}")
    counted = df.observe(seen, F.count(F.lit(1)).alias("rows"))
    writer = (counted.hint("rebalance", *parts) if parts else counted).write.mode("errorifexists")
    (writer.partitionBy(*parts) if parts else writer).parquet(f"{root}/{folder}")
    manifest = spark.range(1).select(
        F.lit(number).cast("bigint").alias("version"), F.lit(name or str(number)).alias("name"), F.lit(folder).alias("folder"),
        F.array(*[F.lit(p) for p in parts]).cast("array<string>").alias("parts"),
        F.lit(seen.get["rows"]).cast("bigint").alias("rows"), F.current_timestamp().cast("timestamp_ntz").alias("committed"))
    manifest.coalesce(1).write.mode("append").json(f"{root}/versions")
    return number


def read_version(spark: SparkSession, root: str, version: int | None = None, name: str | None = None) -> DataFrame:
    """The newest version, or the one of a number or name."""
    known = list_versions(spark, root)
    if version is not None:
        known = known.where(F.col("version") == version)
    if name is not None:
        known = known.where(F.col("name") == name)
    found = known.orderBy(F.desc("version")).limit(2).collect()
    if not found:
        raise NoSuchVersion(f"{root}: no version" + (f" {version}" if version is not None else "") + (f" named {name}" if name is not None else ""))
    if len(found) == 2 and found[0]["version"] == found[1]["version"]:
        raise ValueError(f"{root}: version {found[0]['version']} was committed twice")
    return spark.read.parquet(f"{root}/{found[0]['folder']}")


def check_version(spark: SparkSession, root: str, version: int | None = None) -> bool:
    """Whether the files of a version hold as many rows as its manifest tells."""
    known = list_versions(spark, root)
    wanted = known.agg(F.max("version")).first()[0] if version is None else version
    told = known.where(F.col("version") == wanted).select("rows").first()
    return told is not None and read_version(spark, root, wanted).count() == told["rows"]
