"""Staging projections, dimensions and facts."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, functions as F

from ..functions import iban, phone, risk, text
from ..operators.keyed import spread_join

USABLE = ("valid", "warning")


def record_key() -> Column:
    """Stable key of a canonical row: the same source row always gets the same key."""
    return F.md5(F.concat_ws("|", "source_system_id", "source_record_id"))


def _clock(c: str) -> Column:
    return F.date_format(c, "HH:mm:ss")


def stg_bank_transactions(canonical: DataFrame) -> DataFrame:
    return (canonical.where(F.col("validation_status").isin(*USABLE))
            .where("debtor_account_id IS NOT NULL OR creditor_account_id IS NOT NULL")
            .select(record_key().alias("transaction_id"), "investigation_id",
                    F.col("source_system_id").alias("source_id"), F.col("debtor_account_id").alias("iban_from"),
                    F.col("creditor_account_id").alias("iban_to"), F.col("amount").alias("bedrag"),
                    F.to_date("transaction_datetime").alias("datum"), "posting_date", "value_date",
                    F.col("description").alias("omschrijving"), "debtor_name", "creditor_name", "transaction_type",
                    "payment_method", "currency_code", "validation_status", "data_completeness_score"))


def _stg_communications(canonical: DataFrame, kind: str) -> DataFrame:
    return (canonical.where((F.col("communication_type") == kind) & F.col("validation_status").isin(*USABLE))
            .where("originator_id IS NOT NULL OR recipient_id IS NOT NULL"))


def stg_telecom_calls(canonical: DataFrame) -> DataFrame:
    return _stg_communications(canonical, "call").select(
        record_key().alias("call_id"), "investigation_id", F.col("source_system_id").alias("source_id"),
        F.col("originator_id").alias("caller_number"), F.col("recipient_id").alias("called_number"),
        F.col("communication_datetime").alias("call_timestamp"),
        F.to_date("communication_datetime").alias("call_date"), _clock("communication_datetime").alias("call_time"),
        F.coalesce("duration_seconds", F.lit(0)).alias("duration_seconds"),
        F.col("direction").alias("call_direction"), F.col("call_status").alias("call_type"),
        "network_operator", "connection_type", "validation_status")


def stg_telecom_messages(canonical: DataFrame) -> DataFrame:
    return _stg_communications(canonical, "sms").select(
        record_key().alias("message_id"), "investigation_id", F.col("source_system_id").alias("source_id"),
        F.col("originator_id").alias("sender_number"), F.col("recipient_id").alias("recipient_number"),
        F.col("communication_datetime").alias("message_timestamp"),
        F.to_date("communication_datetime").alias("message_date"),
        _clock("communication_datetime").alias("message_time"),
        F.col("message_content").alias("message_text"), F.col("content_hash").alias("message_hash"),
        F.col("direction").alias("message_direction"), "network_operator", "validation_status")


def _distinct_values(df: DataFrame, columns: list[str], name: str) -> DataFrame:
    """Distinct non-null values of several columns from one scan."""
    return df.select(F.explode(F.array(*columns)).alias(name)).where(F.col(name).isNotNull()).distinct()


def _current(df: DataFrame, as_of: dt.datetime, system: str) -> DataFrame:
    return df.withColumns({
        "valid_from": F.lit(as_of).cast("timestamp_ntz"), "valid_to": F.lit(None).cast("timestamp_ntz"),
        "is_current": F.lit(True), "source_system": F.lit(system)})


def dim_bank_account(stg: DataFrame, as_of: dt.datetime) -> DataFrame:
    accounts = _distinct_values(stg, ["iban_from", "iban_to"], "iban").where(iban.valid_strict(F.col("iban")))
    c = F.col("iban")
    return _current(accounts.select(
        F.md5(c).alias("account_key"), "iban", iban.country(c).alias("country_code"),
        iban.bank_code(c).alias("bank_code"), iban.account_number(c).alias("account_number"),
        iban.bank_name(iban.bank_code(c)).alias("bank_name"), F.lit("checking").alias("account_type"),
        F.lit("EUR").alias("currency")), as_of, "consolidated")


def dim_phone_number(calls: DataFrame, messages: DataFrame, as_of: dt.datetime) -> DataFrame:
    seen = _distinct_values(calls, ["caller_number", "called_number"], "n").union(
        _distinct_values(messages, ["sender_number", "recipient_number"], "n"))
    numbers = seen.select(phone.normalize_nl(F.col("n")).alias("phone_number")).distinct()
    c = F.col("phone_number")
    return _current(numbers.where(phone.valid(c)).select(
        F.md5(c).alias("phone_key"), "phone_number", phone.country_code(c).alias("country_code"),
        phone.area_code(c).alias("area_code"), phone.local_number(c).alias("local_number"),
        phone.phone_type(c).alias("phone_type"), phone.provider(c).alias("provider"),
        F.lit(True).alias("is_valid")), as_of, "demo_system")


def _with_key(fact: DataFrame, dim: DataFrame, natural: str, key: str, column: str, out: str) -> DataFrame:
    """Look the current dimension key up. Only the keys of a task are held, not the rows of a busy account or number."""
    current = dim.where("is_current").select(F.col(natural).alias(column), F.col(key).alias(out))
    return spread_join(fact, current.hint("shuffle_hash"), [column])


def fact_transaction(stg: DataFrame, dim: DataFrame) -> DataFrame:
    keyed = stg
    for side in ("from", "to"):
        keyed = _with_key(keyed, dim, "iban", "account_key", f"iban_{side}", f"account_key_{side}")
    amount, words = F.col("bedrag"), F.col("omschrijving")
    noon = F.col("datum").cast("timestamp_ntz") + F.expr("INTERVAL 12 HOURS")
    return keyed.select(
        "transaction_id", "investigation_id", "source_id", F.col("datum").alias("transaction_date"),
        noon.alias("transaction_timestamp"), F.col("datum").alias("posted_date"), "iban_from", "iban_to",
        "account_key_from", "account_key_to", amount.alias("amount"), F.lit("EUR").alias("currency"),
        F.when(amount > 0, "credit").when(amount < 0, "debit").otherwise("neutral").alias("transaction_type"),
        text.category(words).alias("category"), words.alias("description"),
        text.last_token(words).alias("counter_party_name"), F.lit(None).cast("string").alias("reference"),
        risk.transaction_suspicious(amount, words).alias("is_suspicious"),
        risk.transaction_score(amount).alias("risk_score"), F.array().cast("array<string>").alias("tags"))


def fact_call(stg: DataFrame, dim: DataFrame) -> DataFrame:
    keyed = stg
    for side in ("caller", "called"):
        keyed = _with_key(keyed, dim, "phone_number", "phone_key", f"{side}_number", f"{side}_phone_key")
    seconds, at = F.col("duration_seconds"), F.col("call_timestamp")
    missed = F.col("call_type").isin("missed", "unanswered")
    direction = (F.when(missed, "missed").when(F.col("call_direction").isin("inbound", "outbound"), F.col("call_direction"))
                 .otherwise("unknown"))
    return keyed.select(
        "call_id", "investigation_id", "source_id", at.alias("call_date"), F.to_date(at).alias("call_date_only"),
        F.date_format(at, "HH:mm:ss").alias("call_time"), "caller_number", "called_number", "caller_phone_key",
        "called_phone_key", "duration_seconds", F.round(seconds / F.lit(60.0), 2).alias("duration_minutes"),
        F.coalesce("call_type", F.lit("unknown")).alias("call_type"), direction.alias("call_direction"),
        risk.call_suspicious(seconds).alias("is_suspicious"), risk.call_score(seconds, at).alias("risk_score"),
        F.array().cast("array<string>").alias("tags"))


def fact_message(stg: DataFrame, dim: DataFrame) -> DataFrame:
    keyed = stg
    for side in ("sender", "recipient"):
        keyed = _with_key(keyed, dim, "phone_number", "phone_key", f"{side}_number", f"{side}_phone_key")
    words, at, way = F.col("message_text"), F.col("message_timestamp"), F.col("message_direction")
    direction = (F.when(way.isin("sent", "outgoing", "outbound"), "outbound")
                 .when(way.isin("received", "incoming", "inbound"), "inbound").otherwise("unknown"))
    return keyed.select(
        "message_id", "investigation_id", "source_id", at.alias("message_date"),
        F.to_date(at).alias("message_date_only"), F.date_format(at, "HH:mm:ss").alias("message_time"),
        "sender_number", "recipient_number", "sender_phone_key", "recipient_phone_key", "message_text",
        F.length(F.coalesce(words, F.lit(""))).alias("message_length"), text.word_count(words).alias("word_count"),
        F.lit("sms").alias("message_type"), direction.alias("message_direction"),
        risk.message_suspicious(words).alias("is_suspicious"), risk.message_score(words, at).alias("risk_score"),
        risk.message_tags(words).alias("tags"))
