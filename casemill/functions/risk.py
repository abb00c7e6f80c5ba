"""Suspicion flags and risk scores. Bands and words are fixed values, first match wins."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from .dates import hour_between
from .text import contains_any, first_match

BASE_SCORE = 0.10

# Fixed values: (amount above, score).
AMOUNT_BANDS = ((50000, 1.00), (10000, 0.75), (5000, 0.50), (1000, 0.25))
SUSPICIOUS_AMOUNT = 10000

# Fixed values: (seconds above, score) and (first hour, last hour, score).
CALL_BANDS = ((7200, 1.00), (3600, 0.75), (1800, 0.50))
CALL_HOURS = ((0, 5, 0.60), (22, 23, 0.40))
LONG_CALL, SHORT_CALL = 3600, 1

# Fixed values for messages.
MESSAGE_ALERT_WORDS = ("urgent", "password", "bank", "account", "transfer")
MESSAGE_WORD_SCORES = ((("password", "pin"), 1.00), (("bank", "account"), 0.75), (("urgent", "transfer"), 0.60))
MESSAGE_TAGS = ((("bank",), "banking"), (("meet", "appointment"), "meeting"), (("urgent",), "urgent"))
LONG_MESSAGE = 500


def transaction_suspicious(amount: Column, text: Column) -> Column:
    big = F.coalesce(F.abs(amount) > SUSPICIOUS_AMOUNT, F.lit(False))
    return big | contains_any(text, ("suspicious",))


def transaction_score(amount: Column) -> Column:
    return first_match(((F.abs(amount) > edge, score) for edge, score in AMOUNT_BANDS), BASE_SCORE)


def call_suspicious(seconds: Column) -> Column:
    return F.coalesce((seconds > LONG_CALL) | (seconds < SHORT_CALL), F.lit(False))


def call_score(seconds: Column, at: Column) -> Column:
    bands = [(seconds > edge, score) for edge, score in CALL_BANDS]
    hours = [(hour_between(at, lo, hi), score) for lo, hi, score in CALL_HOURS]
    return first_match(bands + hours, BASE_SCORE)


def message_suspicious(text: Column) -> Column:
    long = F.coalesce(F.length(text) > LONG_MESSAGE, F.lit(False))
    return contains_any(text, MESSAGE_ALERT_WORDS) | long


def message_score(text: Column, at: Column) -> Column:
    rules = [(contains_any(text, words), score) for words, score in MESSAGE_WORD_SCORES]
    rules.append((F.length(text) > LONG_MESSAGE, 0.50))
    rules.append((hour_between(at, 0, 5), 0.40))
    return first_match(rules, BASE_SCORE)


def message_tags(text: Column) -> Column:
    none = F.array().cast("array<string>")
    return first_match(((contains_any(text, w), F.array(F.lit(tag))) for w, tag in MESSAGE_TAGS), none)
