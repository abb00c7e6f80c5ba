"""Registration of queries and assembly of their check statements."""

from __future__ import annotations

import re
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from ..session import LONG_EXPRESSIONS, prepare
from .inputs import INPUTS, TABLES

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}
STAGES: dict[str, str] = {}


class Data:
    """The given tables of one scale folder and the inputs derived from them, by name."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark, self.sf_dir = spark, sf_dir

    def __getattr__(self, name: str) -> DataFrame:
        if name in TABLES:
            return self.spark.read.parquet(f"{self.sf_dir}/{name}.parquet")
        if name not in INPUTS:
            raise AttributeError(name)
        statement = INPUTS[name]
        for table in TABLES:
            if re.search(rf"\b{table}\b", statement):
                getattr(self, table).createOrReplaceTempView(table)
        for other in INPUTS:
            if other != name and re.search(rf"\b{other}\b", statement):
                getattr(self, other).createOrReplaceTempView(other)
        return self.spark.sql(statement)


def plain(df: DataFrame) -> DataFrame:
    """Columns in comparable types: whole numbers long, decimals double, lists as text, times without zone."""
    out = []
    for field in df.schema.fields:
        c, kind = F.col(f"`{field.name}`"), field.dataType
        if isinstance(kind, (T.ByteType, T.ShortType, T.IntegerType)):
            c = c.cast("bigint")
        elif isinstance(kind, (T.DecimalType, T.FloatType)):
            c = c.cast("double")
        elif isinstance(kind, T.ArrayType):
            c = F.array_join(c, "|")
        elif isinstance(kind, T.TimestampType):
            c = c.cast("timestamp_ntz")
        out.append(c.alias(field.name))
    return df.select(*out)


def query(name: str, sql: str | None = None):
    """Register ``fn(data)`` under a name; ``sql`` may use the derived inputs and the stages below."""

    def add(fn):
        QUERIES[name] = lambda spark, sf_dir: plain(fn(Data(prepare(spark, LONG_EXPRESSIONS), sf_dir)))
        if sql is not None:
            SQL[name] = with_parts(sql)
        return fn

    return add


def stage(name: str, sql: str) -> None:
    """A named subquery check statements can build on."""
    STAGES[name] = sql


def with_parts(sql: str) -> str:
    """Prefix the statement with every input and stage it leads to, in order of need."""
    parts = {**INPUTS, **STAGES}
    ordered: list[str] = []

    def need(text: str) -> None:
        for word in re.findall(r"\b(?:fx|st)_\w+", text):
            if word in parts and word not in ordered:
                need(parts[word])
                if word not in ordered:
                    ordered.append(word)

    need(sql)
    if not ordered:
        return sql
    return "WITH " + ",\n".join(f"{n} AS ({parts[n]})" for n in ordered) + "\n" + sql
