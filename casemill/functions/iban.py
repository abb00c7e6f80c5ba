"""IBAN rules."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

# Bank codes and their names.
BANKS = {
    "ABNA": "ABN AMRO",
    "INGB": "ING Bank",
    "RABO": "Rabobank",
    "TRIO": "Triodos Bank",
    "SNSB": "SNS Bank",
    "ASNB": "ASN Bank",
    "RBRB": "RegioBank",
    "BUNQ": "bunq",
    "KNAB": "Knab",
    "REVOLT": "Revolut",
}
UNKNOWN_BANK = "Unknown Bank"

# Characters of the bank code after the check digits, per country.
BANK_CODE_LENGTH = {"NL": 4, "BE": 3, "DE": 8}
OTHER_BANK_CODE_LENGTH = 4


def valid_strict(c: Column) -> Column:
    """15 to 34 characters: country, two check digits, then capitals or digits."""
    return F.coalesce(c.rlike(r"^[A-Z]{2}[0-9]{2}[A-Z0-9]{11,30}$"), F.lit(False))


def valid_loose(c: Column) -> Column:
    """As strict, but blanks and case do not matter and the tail may be short."""
    packed = F.upper(F.translate(c, " ", ""))
    return F.coalesce(packed.rlike(r"^[A-Z]{2}[0-9]{2}[A-Z0-9]{1,30}$"), F.lit(False))


def valid_flag(c: Column) -> Column:
    """The check made on intake: any length of tail."""
    return F.coalesce(F.upper(F.trim(c)).rlike(r"^[A-Z]{2}\d{2}[A-Z0-9]+$"), F.lit(False))


def normalize(c: Column) -> Column:
    """Packed capitals when that makes a valid IBAN, else the text in capitals."""
    packed = F.upper(F.translate(c, " -", ""))
    return F.when(c == "", None).when(valid_loose(packed), packed).otherwise(F.upper(c))


def country(c: Column) -> Column:
    return F.substring(c, 1, 2)


def bank_code(c: Column) -> Column:
    rule = F.substring(c, 5, OTHER_BANK_CODE_LENGTH)
    for land, size in BANK_CODE_LENGTH.items():
        rule = F.when(country(c) == land, F.substring(c, 5, size)).otherwise(rule)
    return rule


def account_number(c: Column) -> Column:
    start = F.when(country(c) == "NL", 9).otherwise(13)
    return F.substring(c, start, F.length(c))


def bank_name(code: Column) -> Column:
    names = F.create_map(*[F.lit(x) for pair in BANKS.items() for x in pair])
    return F.coalesce(F.try_element_at(names, code), F.lit(UNKNOWN_BANK))
