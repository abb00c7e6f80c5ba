"""Masks for personal data; null stays null."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

STARS = "****"
REDACTED = "***REDACTED***"


def _edges(c: Column, head: int, tail: int) -> Column:
    return F.concat(F.left(c, F.lit(head)), F.lit(STARS), F.right(c, F.lit(tail)))


def iban_long(c: Column) -> Column:
    return _edges(c, 8, 4)


def iban_short(c: Column) -> Column:
    return _edges(c, 4, 4)


def phone_edges(c: Column) -> Column:
    return _edges(c, 4, 3)


def phone_tail(c: Column) -> Column:
    return F.concat(F.lit(STARS), F.right(c, F.lit(4)))


def redact(c: Column) -> Column:
    return F.when(c.isNotNull(), F.lit(REDACTED))


def digest(c: Column) -> Column:
    return F.md5(c)
