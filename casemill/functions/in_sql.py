"""The column functions under names of their own in SQL.

Each is a temporary function whose body is one SQL expression, so the optimiser inlines it: filters on it
are pushed down like any other, and no function is called by row. Patterns and names come from the modules
that hold the column functions; the tests hold both forms against each other.
"""

from __future__ import annotations

from pyspark.sql import SparkSession

from . import iban, phone
from .mask import STARS


def _quoted(text: str) -> str:
    """A raw literal: patterns keep their backslashes."""
    return f"r'{text}'"


def _matches(pattern: str) -> str:
    return f"rlike(x, {_quoted(pattern)})"


def _bank_code() -> str:
    sizes = " ".join(f"WHEN '{land}' THEN {size}" for land, size in iban.BANK_CODE_LENGTH.items())
    return f"substring(x, 5, CASE left(x, 2) {sizes} ELSE {iban.OTHER_BANK_CODE_LENGTH} END)"


def _bank_name() -> str:
    names = " ".join(f"WHEN '{code}' THEN '{name}'" for code, name in iban.BANKS.items())
    return f"CASE x {names} ELSE '{iban.UNKNOWN_BANK}' END"


def _provider() -> str:
    ranges = " ".join(f"WHEN {_matches(f'^(06|[+]316){digits}')} THEN '{name}'" for name, digits in phone.PROVIDERS.items())
    return f"CASE {ranges} ELSE 'Unknown' END"


TEXT, DAY = "x STRING", "x DATE"
# name → (argument, result type, body)
FUNCTIONS: dict[str, tuple[str, str, str]] = {
    "validate_iban": (TEXT, "BOOLEAN", f"coalesce({_matches('^[A-Z]{2}[0-9]{2}[A-Z0-9]{11,30}$')}, false)"),
    "extract_country_from_iban": (TEXT, "STRING", "left(x, 2)"),
    "extract_bank_code_from_iban": (TEXT, "STRING", _bank_code()),
    "get_bank_name_from_code": (TEXT, "STRING", _bank_name()),
    "validate_phone_number": (TEXT, "BOOLEAN", "coalesce(length(x) BETWEEN 10 AND 15 AND ({}), false)".format(
        " OR ".join(_matches(p) for p in (phone.NL_MOBILE, phone.NL_LANDLINE, phone.INTERNATIONAL)))),
    "normalize_phone_number": (TEXT, "STRING", f"""CASE WHEN {_matches('^(06[0-9]{8}|0[1-57-9][0-9]{7,8})$')} THEN '+31' || substring(x, 2)
        WHEN {_matches('^[+][0-9]+$')} THEN x ELSE '+31' || x END"""),
    "extract_country_code_from_phone": (TEXT, "STRING", "CASE WHEN startswith(x, '+') THEN left(x, 3) ELSE '+31' END"),
    "get_phone_type": (TEXT, "STRING", f"""CASE WHEN {_matches('^([+]316|06)')} THEN 'mobile'
        WHEN {_matches('^([+]31[1-57-9]|0[1-57-9])')} THEN 'landline' WHEN {_matches('^[+][0-9]{2}[6-9]')} THEN 'mobile' ELSE 'unknown' END"""),
    "detect_phone_provider": (TEXT, "STRING", _provider()),
    "extract_date": ("x TIMESTAMP_NTZ", "DATE", "CAST(x AS DATE)"),
    "calculate_age": ("x DATE, as_of DATE", "INT", "CAST(timestampdiff(YEAR, CAST(x AS TIMESTAMP_NTZ), CAST(as_of AS TIMESTAMP_NTZ)) AS INT)"),
    "hash_sensitive_data": (TEXT, "STRING", "md5(x)"),
    "mask_iban": (TEXT, "STRING", f"left(x, 8) || '{STARS}' || right(x, 4)"),
    "mask_phone": (TEXT, "STRING", f"left(x, 4) || '{STARS}' || right(x, 3)"),
}


def register(spark: SparkSession, prefix: str = "") -> list[str]:
    """Create every function in the session under ``prefix`` and its name; null in, null out, but false for validity.

    ``uuid()`` and ``current_timestamp()`` are part of SQL. The age takes the day it is asked for as second argument.
    """
    for name, (arguments, kind, body) in FUNCTIONS.items():
        spark.sql(f"CREATE OR REPLACE TEMPORARY FUNCTION {prefix}{name}({arguments}) RETURNS {kind} RETURN {body}")
    return [prefix + name for name in FUNCTIONS]
