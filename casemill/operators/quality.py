"""Data-quality rules, contracts, profiles and scores."""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, functions as F

from ..functions import iban, phone

# ---- row rules ------------------------------------------------------------------------------
# Each gives the condition of a failing row; nulls pass unless the rule is about nulls.


def not_null(c: str) -> Column:
    return F.col(c).isNull()


def accepted_values(c: str, values: Sequence) -> Column:
    return F.col(c).isNotNull() & ~F.col(c).isin(*values)


def positive(c: str) -> Column:
    return F.col(c) < 0


def between(c: str, low, high) -> Column:
    return (F.col(c) < low) | (F.col(c) > high)


def iban_format(c: str) -> Column:
    return F.col(c).isNotNull() & ~iban.valid_strict(F.col(c))


def phone_format(c: str) -> Column:
    return F.col(c).isNotNull() & ~phone.valid(F.col(c))


def regex(c: str, pattern: str) -> Column:
    return ~F.col(c).rlike(pattern)


def max_length(c: str, size: int) -> Column:
    return F.length(c) > size


# ---- table rules ----------------------------------------------------------------------------


def duplicates(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Keys that occur more than once, with their count."""
    known = df.na.drop(subset=list(keys)) if len(keys) == 1 else df
    return known.groupBy(*keys).agg(F.count("*").alias("n")).where("n > 1")


def orphans(child: DataFrame, column: str, parent: DataFrame, parent_column: str) -> DataFrame:
    """Child rows whose reference is not in the parent table."""
    ids = parent.select(F.col(parent_column).alias(column))
    return child.where(F.col(column).isNotNull()).join(ids, [column], "left_anti").select(*child.columns)


def rule_result(rule: str, column: str, checked: DataFrame, failing: DataFrame) -> DataFrame:
    """One summary row of a table rule."""
    both = (checked.agg(F.count("*").alias("checked")).withColumn("failed", F.lit(0).cast("bigint"))
            .unionByName(failing.agg(F.count("*").alias("failed")).withColumn("checked", F.lit(0).cast("bigint"))))
    total = both.agg(F.sum("checked").alias("checked"), F.sum("failed").alias("failed"))
    return total.select(F.lit(rule).alias("rule"), F.lit(column).alias("column"), "checked", "failed",
                        (F.col("failed") == 0).alias("passed"))


@dataclass(frozen=True)
class Rule:
    name: str
    column: str
    fails: Column


def failing_rows(df: DataFrame, rule: Rule) -> DataFrame:
    return df.where(F.coalesce(rule.fails, F.lit(False)))


def check_rows(df: DataFrame, rules: Sequence[Rule]) -> DataFrame:
    """All row rules in one pass over the table: rule, column, checked, failed, passed."""
    counts = [F.struct(F.lit(r.name).alias("rule"), F.lit(r.column).alias("column"),
                       F.count("*").alias("checked"), F.count_if(r.fails).alias("failed")) for r in rules]
    melted = df.agg(F.array(*counts).alias("r")).select(F.inline("r"))
    return melted.withColumn("passed", F.col("failed") == 0)


# ---- weather gate, profile, scores ----------------------------------------------------------


def weather_checks() -> dict[str, Column]:
    """Fixed values, names included: the seven conditions every observation must meet."""
    col = F.col
    return {
        "temperature_range": col("temperature").between(-30, 45),
        "humidity_range": col("humidity").between(0, 100),
        "wind_speed_positive": col("wind_speed") >= 0,
        "precipitation_positive": col("precipitation") >= 0,
        "no_null_temperature": col("temperature").isNotNull(),
        "no_null_station": col("station_name").isNotNull(),
        "valid_coordinates": col("latitude").between(50.7, 53.6) & col("longitude").between(3.3, 7.2),
    }


def weather_quality(obs: DataFrame) -> DataFrame:
    """Per check: failing rows and pass flag, with the share of passed checks as score."""
    rules = [Rule(name, name, ~F.coalesce(ok, F.lit(False))) for name, ok in weather_checks().items()]
    counts = F.array(*[F.struct(F.lit(r.name).alias("check"), F.count_if(r.fails).alias("failed_rows"))
                       for r in rules])
    packed = obs.agg(counts.alias("r"), F.count("*").alias("total"))
    good = F.size(F.filter("r", lambda x: x["failed_rows"] == 0)).cast("bigint")
    scored = packed.withColumn("passed_checks", good).withColumn(
        "quality_score", F.round(good * 100.0 / len(rules), 2))
    return scored.select(F.inline("r"), "total", "passed_checks", "quality_score").withColumn(
        "passed", F.col("failed_rows") == 0)


def quality_badge(score: Column) -> Column:
    return F.when(score >= 95, "high-quality").when(score >= 80, "good-quality").otherwise("needs-attention")


def mapping_quality(canonical: DataFrame) -> DataFrame:
    status = F.col("validation_status")
    counts = canonical.agg(F.count("*").alias("total"), *[
        F.count_if(status == s).alias(s) for s in ("valid", "warning", "error")])
    share = lambda c: F.round(c.cast("double") * 100 / F.nullif(F.col("total"), F.lit(0)), 2)
    return counts.withColumns({"validation_rate": share(F.col("valid") + F.col("warning")),
                               "quality_score": share(F.col("valid"))})


def source_freshness(df: DataFrame, source: str, loaded_at: str, as_of: dt.datetime) -> DataFrame:
    newest = df.groupBy(source).agg(F.max(loaded_at).alias("last_loaded"))
    age = F.timestamp_diff("SECOND", F.col("last_loaded"), F.lit(as_of).cast("timestamp_ntz"))
    return newest.withColumn("age_hours", F.floor(age / 3600))


def profile_dataset(df: DataFrame, file_type: str, amount: str = "bedrag", account: str = "iban",
                    date: str = "datum", at: str = "timestamp", duration: str = "duration_seconds",
                    phones: Sequence[str] = ("caller", "callee", "sender", "recipient")) -> DataFrame:
    """File profile as (metric, column, value) rows, values as text.

    Counts, extremes and moments come from one aggregation whose states merge. Distinct values are grouped by
    value, duplicate rows by a 256-bit digest of the row, so no row is shuffled whole.
    """
    total = F.count("*")
    kinds = dict(df.dtypes)

    def row(metric, column, value):
        return F.struct(F.lit(metric).alias("metric"), F.lit(column).alias("column"),
                        value.cast("string").alias("value"))

    def share(n):
        return F.round(n * 100.0 / F.nullif(total, F.lit(0)), 2).cast("double")

    rows = [row("row_count", "", total), row("column_count", "", F.lit(len(df.columns)))]
    for c in df.columns:
        empty = F.count_if(F.col(c).isNull())
        rows += [row("null_count", c, empty), row("null_pct", c, share(empty)), row("dtype", c, F.lit(kinds[c]))]
    if file_type == "bank_transactions":
        if amount in kinds:
            x = F.col(amount)
            rows += [row("amount_sum", amount, F.sum(x).cast("decimal(30,2)")),
                     row("amount_mean", amount, F.round(F.avg(x.cast("double")), 4)),
                     row("amount_min", amount, F.min(x)), row("amount_max", amount, F.max(x)),
                     row("amount_std", amount, F.round(F.stddev_samp(x.cast("double")), 4))]
        if date in kinds:
            rows += [row("first_date", date, F.min(date)), row("last_date", date, F.max(date))]
    else:
        if at in kinds:
            rows += [row("first_timestamp", at, F.min(at)), row("last_timestamp", at, F.max(at))]
        if file_type == "call_records" and duration in kinds:
            x = F.col(duration)
            rows += [row("duration_total", duration, F.sum(x)), row("duration_max", duration, F.max(x)),
                     row("duration_mean", duration, F.round(F.avg(x), 4))]
    out = df.agg(F.array(*rows).alias("r")).select(F.inline("r"))

    every_cell = F.to_json(F.struct(*[F.col(f"`{c}`") for c in df.columns]), {"ignoreNullFields": "false"})
    same = df.select(F.unhex(F.sha2(every_cell, 256)).alias("_row")).groupBy("_row").agg(F.count("*").alias("_n"))
    extra, every = F.sum(F.col("_n") - 1), F.sum("_n")
    twice = same.agg(F.array(
        row("duplicate_rows", "", F.coalesce(extra, F.lit(0))),
        row("duplicate_pct", "", F.round(F.coalesce(extra * 100.0 / every, F.lit(0)), 2).cast("double"))).alias("r"))
    out = out.unionByName(twice.select(F.inline("r")))

    if file_type == "bank_transactions" and account in kinds:
        known = df.groupBy(account).agg(F.lit(1).alias("_one")).agg(F.array(row("unique_ibans", account, F.count(account))).alias("r"))
        out = out.unionByName(known.select(F.inline("r")))

    numbers = [c for c in phones if c in kinds]
    if file_type != "bank_transactions" and numbers:
        each = df.select(F.explode(F.array(*numbers)).alias("number")).where("number IS NOT NULL")
        found = each.groupBy("number").agg(F.count("*").alias("n")).agg(F.array(
            row("unique_phone_numbers", "", F.count("*")),
            row("total_phone_numbers", "", F.coalesce(F.sum("n"), F.lit(0)))).alias("r"))
        out = out.unionByName(found.select(F.inline("r")))
    return out
