"""Who may see which rows and columns, and the record of changes to that."""

from __future__ import annotations

import datetime as dt
from collections.abc import Iterable

from pyspark.sql import Column, DataFrame, functions as F

from ..functions import mask
from .keyed import newest_per_key, spread_join

# Fixed values.
SEES_ALL = {"raw": {"platform_admin", "data_engineer"},
            "canonical": {"platform_admin", "data_engineer", "data_analyst"}}
BY_GRANT = "investigator"
CLAIMS = "preferred_username string, sub string, email string, realm_access struct<roles: array<string>>"


def moment(as_of: dt.datetime) -> Column:
    return F.lit(as_of).cast("timestamp_ntz")


def is_active(as_of: dt.datetime) -> Column:
    return F.coalesce(F.col("expires_at") > moment(as_of), F.lit(True))


def apply_row_policy(df: DataFrame, layer: str, roles: Iterable[str], user: str, grants: DataFrame,
                     as_of: dt.datetime) -> DataFrame:
    """All rows, the rows of the user's unexpired cases, or none."""
    roles = set(roles)
    if roles & SEES_ALL[layer]:
        return df
    if BY_GRANT not in roles:
        return df.where(F.lit(False))
    mine = grants.where((F.col("user_id") == user) & is_active(as_of)).select("investigation_id").distinct()
    return spread_join(df, mine, ["investigation_id"], "left_semi").select(*df.columns)


def my_access(cases: DataFrame, grants: DataFrame, user: str, as_of: dt.datetime) -> DataFrame:
    mine = grants.where(F.col("user_id") == user).withColumn("is_active", is_active(as_of))
    return cases.join(mine, "investigation_id").select(
        "investigation_id", "name", "status", "access_level", "expires_at", "is_active")


def access_matrix(cases: DataFrame, grants: DataFrame, as_of: dt.datetime, user: str | None = None) -> DataFrame:
    """Every grant with the case name, a readable expiry and an active label."""
    rows = grants if user is None else grants.where(F.col("user_id") == user)
    day = F.date_format("expires_at", "yyyy-MM-dd")
    left = F.timestamp_diff("DAY", moment(as_of), F.col("expires_at")).cast("string")
    label = (F.when(F.col("expires_at").isNull(), "Permanent")
             .when(is_active(as_of), F.concat(day, F.lit(" ("), left, F.lit(" days left)")))
             .otherwise(F.concat(F.lit("EXPIRED ("), day, F.lit(")"))))
    named = rows.join(cases.select("investigation_id", F.col("name").alias("investigation_name")),
                      "investigation_id", "left")
    return named.select("user_id", "investigation_id", "investigation_name", "access_level",
                        label.alias("expires"),
                        F.when(is_active(as_of), "ACTIVE").otherwise("EXPIRED").alias("status")).orderBy(
        F.when(F.col("status") == "ACTIVE", 0).otherwise(1), "investigation_id", "user_id")


def grant_counts(grants: DataFrame, as_of: dt.datetime) -> DataFrame:
    return grants.agg(F.count_if(is_active(as_of)).alias("active"), F.count_if(~is_active(as_of)).alias("expired"))


def apply_grants(grants: DataFrame, requests: DataFrame, as_of: dt.datetime) -> DataFrame:
    """Grants after a batch of requests; of several for one user and case the last counts.

    ``requests``: user_id, investigation_id, action (grant or revoke),
    access_level, expires_days, requested_by, seq.
    """
    keys = ["user_id", "investigation_id"]
    last = newest_per_key(requests, keys, ["seq"])
    until = moment(as_of) + F.make_dt_interval(days=F.col("expires_days").cast("int"))
    added = last.where("action = 'grant'").select(
        *keys, "access_level", F.col("requested_by").alias("granted_by"),
        moment(as_of).alias("granted_at"), until.alias("expires_at"))
    return grants.join(last.select(*keys), keys, "left_anti").select(*grants.columns).unionByName(
        added.select(*grants.columns))


def grant_log(requests: DataFrame, as_of: dt.datetime) -> DataFrame:
    granted = F.col("action") == "grant"
    told = F.when(granted, F.concat(F.lit("Granted "), "access_level", F.lit(" access to user "), "user_id")).otherwise(
        F.concat(F.lit("Revoked access from user "), "user_id"))
    return requests.select(
        moment(as_of).alias("event_time"), F.col("requested_by").alias("user_name"),
        F.when(granted, "GRANT_ACCESS").otherwise("REVOKE_ACCESS").alias("event_type"),
        "investigation_id", told.alias("query_text"), "seq")


def audit_recent(log: DataFrame, at: str, tie: str, limit: int = 10) -> DataFrame:
    return log.orderBy(F.col(at).desc(), F.col(tie).desc()).limit(limit)


def decode_claims(tokens: DataFrame) -> DataFrame:
    """User, mail and roles out of the middle part of each token; nothing from a bad one."""
    parts = F.split("token", r"\.")
    body = F.translate(F.element_at(parts, 2), "-_", "+/")
    padded = F.rpad(body, (F.ceil(F.length(body) / 4) * 4).cast("int"), "=")
    good = padded.rlike("^[A-Za-z0-9+/]+={0,2}$")
    text = F.when((F.size(parts) == 3) & good, F.decode(F.unbase64(F.when(good, padded)), "UTF-8"))
    claims = tokens.withColumn("c", F.from_json(text, CLAIMS))
    return claims.select(
        "token_id", F.coalesce("c.preferred_username", "c.sub").alias("username"), F.col("c.email").alias("email"),
        F.coalesce("c.realm_access.roles", F.array().cast("array<string>")).alias("roles"))


def fact_transaction_masked(fact: DataFrame) -> DataFrame:
    return fact.select(
        "transaction_id", "investigation_id", "source_id", "transaction_date", "transaction_timestamp",
        "posted_date", mask.iban_short(F.col("iban_from")).alias("iban_from_masked"),
        mask.iban_short(F.col("iban_to")).alias("iban_to_masked"), "account_key_from", "account_key_to",
        "amount", "currency", "transaction_type", "category", F.length("description").alias("description_length"),
        mask.redact(F.col("counter_party_name")).alias("counter_party_name_masked"), "reference",
        "is_suspicious", "risk_score", "tags")


def fact_call_masked(fact: DataFrame) -> DataFrame:
    return fact.select(
        "call_id", "investigation_id", "source_id", "call_date", "call_date_only", "call_time",
        mask.phone_tail(F.col("caller_number")).alias("caller_number_masked"),
        mask.phone_tail(F.col("called_number")).alias("called_number_masked"),
        "caller_phone_key", "called_phone_key", "duration_seconds", "duration_minutes", "call_type",
        "call_direction", "is_suspicious", "risk_score", "tags")
