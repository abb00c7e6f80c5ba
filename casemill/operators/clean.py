"""Intake cleaning: column names, amounts, dates, numbers."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from ..functions import dates, iban, phone, text

# Other names of the bank columns, in order of preference.
BANK_ALIASES = (
    ("rekeningnummer", "iban"), ("tegenrekening", "tegenrekening_iban"), ("bedrag (eur)", "bedrag"),
    ("valutadatum", "datum"), ("naam tegenpartij", "tegenpartij_naam"),
    ("iban_from", "iban"), ("iban_to", "tegenrekening_iban"),
    ("from_account", "iban"), ("to_account", "tegenrekening_iban"), ("amount", "bedrag"),
    ("date", "datum"), ("description", "omschrijving"), ("transaction_type", "type"),
    ("source_iban", "iban"), ("dest_iban", "tegenrekening_iban"), ("value", "bedrag"),
    ("transaction_date", "datum"), ("narrative", "omschrijving"), ("ccy", "valuta"),
    ("debit_account", "iban"), ("credit_account", "tegenrekening_iban"), ("trans_amount", "bedrag"),
    ("trans_date", "datum"), ("trans_description", "omschrijving"), ("trans_type", "type"),
    ("trans_currency", "valuta"),
)
# Other names of the telecom columns.
TELECOM_ALIASES = (
    ("from_number", "caller"), ("to_number", "callee"), ("message_content", "message_text"),
    ("caller_number", "caller"), ("callee_number", "callee"), ("call_duration", "duration_seconds"),
    ("receiver", "recipient"), ("text_content", "message_text"),
    ("origin", "caller"), ("destination", "callee"), ("duration_sec", "duration_seconds"),
    ("origin_msisdn", "sender"), ("dest_msisdn", "recipient"), ("message_body", "message_text"),
    ("calling_number", "caller"), ("called_number", "callee"), ("duration", "duration_seconds"),
)
# A bank file must hold one column of each set.
ACCOUNT_HEADERS = ("iban", "rekeningnummer", "from_account", "account_number", "source_iban", "dest_iban",
                   "iban_from", "iban_to", "debit_account", "credit_account")
AMOUNT_HEADERS = ("bedrag", "amount", "bedrag (eur)", "value", "trans_amount")
PHONE_COLUMNS = ("caller", "callee", "sender", "recipient")


def lower_header(df: DataFrame) -> DataFrame:
    return df.toDF(*[c.strip().lower() for c in df.columns])


def unify_columns(df: DataFrame, aliases) -> DataFrame:
    """Rename along the alias list; a name already taken is left alone.

    Works on the column names only. A value date that stands next to a booking
    date keeps its own name.
    """
    names = {c: c for c in df.columns}
    for old, target in aliases:
        if old in names and target not in names.values():
            names[old] = target
    return df.withColumnsRenamed({old: target for old, target in names.items() if old != target})


def check_bank_header(columns) -> None:
    for kind, accepted in (("account", ACCOUNT_HEADERS), ("amount", AMOUNT_HEADERS)):
        if not set(columns) & set(accepted):
            raise ValueError(f"no {kind} column; expected one of {', '.join(accepted)}")


def bank_clean(df: DataFrame) -> DataFrame:
    """Amounts to decimals, dates to dates, account in capitals with a format flag."""
    types = dict(df.dtypes)
    out = {}
    if "bedrag" in types:
        out["bedrag"] = (text.dutch_decimal(F.col("bedrag")) if types["bedrag"] == "string"
                         else F.col("bedrag").cast("decimal(15,2)"))
    for name in ("datum", "boekdatum", "valutadatum"):
        if types.get(name) == "string":
            out[name] = dates.dutch_date(F.col(name)).cast("date")
    if "iban" in types:
        out["iban"] = F.upper(F.trim("iban"))
        out["iban_valid"] = iban.valid_flag(F.col("iban"))
    return df.withColumns(out)


def telecom_clean(df: DataFrame) -> DataFrame:
    """Numbers without separators, timestamps, durations in seconds."""
    types = dict(df.dtypes)
    out = {c: phone.intake_clean(F.col(c)) for c in PHONE_COLUMNS if c in types}
    at = "timestamp" if "timestamp" in types else "datetime" if "datetime" in types else None
    if at:
        out["timestamp"] = (F.col(at).try_cast(dates.NTZ) if types[at] == "string" else F.col(at).cast(dates.NTZ))
    if types.get("duration_seconds") == "string":
        out["duration_seconds"] = dates.duration_seconds(F.col("duration_seconds"))
    return df.withColumns(out)
