"""Reading case files, tables and folders."""

from __future__ import annotations

import csv
import datetime as dt
from collections.abc import Iterable
from functools import reduce
from urllib.parse import unquote

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from ..functions.dates import NTZ
from ..operators.clean import check_bank_header, lower_header

# The columns of a tower file.
TOWER_SCHEMA = ("radio string, mcc int, net int, area int, cell bigint, unit int, lon double, lat double, "
                "range bigint, samples bigint, changeable int, created bigint, updated bigint, averageSignal int")
CASE_PREFIX = "OND-"
LAYOUTS = 200  # of the files of one scan
DEFAULT_CASE = "GCS-AUTO"
PART_FILE = r"^part-\d+-([0-9a-f]{8}(?:-[0-9a-f]{4}){3}-[0-9a-f]{12})"


def _csv(spark: SparkSession, paths, multiline: bool) -> DataFrame:
    reader = (spark.read.option("header", True).option("enforceSchema", False).option("escape", '"')
              .option("multiLine", multiline))
    return reader.csv(paths)


def _origin() -> dict[str, Column]:
    """Case and source of each row by the path ``…/case/…/source_rest.csv`` it came from."""
    case = F.nullif(F.regexp_extract("_metadata.file_path", f"({CASE_PREFIX}[^/]+)", 1), F.lit(""))
    return {"investigation_id": F.coalesce(case, F.lit(DEFAULT_CASE)), "source_id": F.regexp_extract("_metadata.file_name", r"^([^_.]+)", 1)}


def scan_bank_csv(spark: SparkSession, paths) -> DataFrame:
    """Bank files of one layout, all text; fails before any work when a needed column is absent."""
    raw = _csv(spark, paths, False)
    check_bank_header([c.strip().lower() for c in raw.columns])
    return _tagged(raw)


def scan_telecom_csv(spark: SparkSession, paths, multiline: bool = False) -> DataFrame:
    """Call or message files of one layout; ``multiline`` for message texts with line breaks."""
    return _tagged(_csv(spark, paths, multiline))


def _tagged(raw: DataFrame) -> DataFrame:
    """Lower-case names; case and source from the path where the file has no columns of its own for them."""
    own = {c.strip().lower() for c in raw.columns}
    return lower_header(raw.withColumns({c: x for c, x in _origin().items() if c not in own}))


def _first_lines(batches):
    """The first line of each file whose beginning this task reads."""
    seen = None
    for batch in batches:
        values, paths = batch.column(0), batch.column(1).dictionary_encode()
        for k in range(batch.num_rows):
            path = paths[k].as_py()
            if path != seen:
                seen = path
                yield pa.record_batch([values.slice(k, 1), pa.array([path], batch.schema.field(1).type)], names=["header", "path"])


def file_layouts(spark: SparkSession, paths) -> DataFrame:
    """(path, header) of CSV files: one pass that parses nothing and returns a line a file."""
    lines = spark.read.text(paths).select("value", F.col("_metadata.file_path").alias("path"), F.col("_metadata.file_block_start").alias("at"))
    return lines.where("at = 0").select("value", "path").mapInArrow(_first_lines, "header string, path string").select("path", "header")


def scan_mixed_csv(spark: SparkSession, paths, needed: Iterable[str] = (), multiline: bool = True) -> DataFrame:
    """Files of several layouts as one table, all text: names in lower case, columns that a file lacks are null.

    Files are grouped by their header (names in lower case, with order); each layout is one scan, so column pruning
    reaches all of them. ``multiline`` allows quoted line breaks. A layout that lacks a ``needed`` column, names a
    column twice, or has no header, fails before any row is read, with one of its files; so do more than LAYOUTS layouts.
    """
    groups = (file_layouts(spark, paths).groupBy(F.lower(F.trim("header")).alias("header"))
              .agg(F.sort_array(F.collect_list("path")).alias("paths")).orderBy("header").limit(LAYOUTS + 1).collect())
    if len(groups) > LAYOUTS:
        raise ValueError(f"more than {LAYOUTS} layouts")
    parts = []
    for group in groups:
        df = _csv(spark, [unquote(p) for p in group["paths"]], multiline)
        names = [c.strip() for c in next(csv.reader([group["header"]]), [])]
        absent = sorted(set(needed) - set(names))
        if absent or len(set(names)) < len(names) or not group["header"]:
            raise ValueError(f"{group['paths'][0]}: " + (f"no column {', '.join(absent)}" if absent else "no header" if not group["header"] else "a column stands twice"))
        parts.append(_tagged(df))
    if not parts:
        raise FileNotFoundError(f"no line in {paths}")
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts)


def scan_tower_csv(spark: SparkSession, paths) -> DataFrame:
    return spark.read.schema(TOWER_SCHEMA).option("header", True).option("mode", "FAILFAST").csv(paths)


def scan_case_parquet(spark: SparkSession, root: str, case: str) -> DataFrame:
    """Rows of one case out of a table partitioned by case; only its folders are read."""
    table = spark.read.option("mergeSchema", True).parquet(root)
    return table.where(F.col("investigation_id") == case)


def register_views(spark: SparkSession, paths: dict[str, str]) -> None:
    for name, path in paths.items():
        spark.read.parquet(path).createOrReplaceTempView(name)


def quick_query(spark: SparkSession, sources: dict[str, DataFrame], sql: str) -> DataFrame:
    for name, df in sources.items():
        df.createOrReplaceTempView(name)
    return spark.sql(sql)


def list_files(spark: SparkSession, root: str) -> DataFrame:
    """Path, time and size of every file below a folder; contents are not read."""
    return (spark.read.format("binaryFile").option("recursiveFileLookup", True).load(root)
            .select("path", F.col("modificationTime").cast(NTZ).alias("created"), F.col("length").alias("size")))


def scan_latest_file(spark: SparkSession, folder: str) -> DataFrame:
    """All Parquet files of the write that came last in a folder.

    Part files of one write carry its id in their names; any other file is a write of its own.
    """
    parts = list_files(spark, folder).where(F.col("path").endswith(".parquet"))
    name = F.element_at(F.split("path", "/"), -1)
    write = F.regexp_extract(name, PART_FILE, 1)
    parts = parts.withColumn("write", F.when(write != "", write).otherwise(F.col("path")))
    newest = parts.orderBy(F.desc("created"), F.desc("path")).limit(1).first()
    if newest is None:
        raise FileNotFoundError(f"no data file in {folder}")
    return spark.read.parquet(*sorted(r["path"] for r in parts.where(F.col("write") == newest["write"]).collect()))


def discover_files(spark: SparkSession, root: str, since: dt.datetime | None = None) -> DataFrame:
    """New files below a bucket with the case and type their path names."""
    files = list_files(spark, root)
    if since is not None:
        files = files.where(F.col("created") > F.lit(since).cast(NTZ))
    return describe_paths(files)


def describe_paths(files: DataFrame) -> DataFrame:
    """Case, type and file name of ``…investigations/case/type/file`` paths."""
    parts = F.split(F.regexp_extract("path", r"investigations/(.+)$", 1), "/")
    known = F.size(parts) >= 3
    return files.withColumns({
        "file_name": F.element_at(F.split("path", "/"), -1),
        "investigation_id": F.when(known, F.try_element_at(parts, F.lit(1))).otherwise(F.lit(DEFAULT_CASE)),
        "source_type": F.when(known, F.try_element_at(parts, F.lit(2))).otherwise(F.lit("unknown"))})


def list_cases(files: DataFrame) -> DataFrame:
    case = F.regexp_extract("path", f"({CASE_PREFIX}[^/]+)/", 1)
    return files.select(case.alias("investigation_id")).where("investigation_id <> ''").distinct()


def file_hashes(spark: SparkSession, root: str) -> DataFrame:
    """Checksums of whole files."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(root)
    return files.select("path", F.col("length").alias("size"), F.sha2("content", 256).alias("sha256"),
                        F.sha1("content").alias("sha1"), F.md5("content").alias("md5"))


def read_jdbc(spark: SparkSession, url: str, table: str, column: str, low, high, parts: int, **options) -> DataFrame:
    """A database table read in ranges of a numeric or time column."""
    reader = spark.read.format("jdbc").options(
        url=url, dbtable=table, partitionColumn=column, lowerBound=str(low), upperBound=str(high),
        numPartitions=str(parts), **options)
    return reader.load()


def topic_stream(spark: SparkSession, servers: str, topic: str, starting: str, per_trigger: int) -> DataFrame:
    """JSON events of a topic as text (needs the Kafka connector).

    ``starting`` holds for the first start only: ``earliest``, ``latest`` (older events are lost) or offsets as JSON.
    """
    raw = spark.readStream.format("kafka").options(
        **{"kafka.bootstrap.servers": servers, "subscribe": topic, "startingOffsets": starting,
           "maxOffsetsPerTrigger": str(per_trigger)}).load()
    return raw.select(F.col("value").cast("string").alias("value"))
