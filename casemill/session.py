"""Session settings and the shared scratch folder."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession

DEFAULTS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
    # bank and source ids look like numbers; keep partition values as text
    "spark.sql.sources.partitionColumnTypeInference.enabled": "false",
    "spark.sql.codegen.hugeMethodLimit": "65535",
}

# The mappings make long expressions, and the JVM compiles no method beyond 8,000 bytes: longer ones are not fused.
# They take far longer than reading does, so files are read in smaller pieces.
LONG_EXPRESSIONS = {
    "spark.sql.codegen.hugeMethodLimit": "8000",
    "spark.sql.files.maxPartitionBytes": "32m",
    "spark.sql.files.openCostInBytes": "1m",
}


def build(app: str = "casemill", master: str | None = None, **conf: str) -> SparkSession:
    """A session with the library defaults; ``conf`` entries win over them."""
    builder = SparkSession.builder.appName(app).config("spark.ui.enabled", "false")
    if master:
        builder = builder.master(master)
    for key, value in {**DEFAULTS, **conf}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def prepare(spark: SparkSession, conf: dict[str, str] | None = None) -> SparkSession:
    """Apply the runtime defaults to a session somebody else created; ``conf`` entries win over them."""
    for key, value in {**DEFAULTS, **(conf or {})}.items():
        spark.conf.set(key, value)
    return spark


def scratch(spark: SparkSession, name: str) -> str:
    """A fresh folder below the cluster's shared checkpoint folder.

    Executors write there, so a machine-local folder is accepted only when the
    whole session runs in one process.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder all executors share")
        root = tempfile.mkdtemp(prefix="casemill-")
    return f"{root.rstrip('/')}/{name}-{uuid.uuid4().hex}"
