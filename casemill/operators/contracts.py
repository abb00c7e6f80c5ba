"""Table contracts: declared schemas compiled to rules that one aggregation counts.

A contract is a dictionary in the form of a JSON schema, so a declaration in a file serves as well as
the ones below: ``compile_contract(json.load(f))``.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, functions as F

from .canonical import TRANSACTION_TYPES
from .quality import Rule, accepted_values, check_rows, max_length, not_null, regex

UUID = "^[0-9a-fA-F]{8}(-[0-9a-fA-F]{4}){3}-[0-9a-fA-F]{12}$"
# Spark types that carry a declared type; an object is a nested value or its JSON text.
CARRIERS = {
    "integer": ("tinyint", "smallint", "int", "bigint"),
    "number": ("tinyint", "smallint", "int", "bigint", "decimal", "float", "double"),
    "boolean": ("boolean",),
    "object": ("struct", "map", "variant", "string"),
    "array": ("array",),
    "string": ("string",),
    "date": ("date",),
    "date-time": ("timestamp", "timestamp_ntz"),
}


# ---- declarations ---------------------------------------------------------------------------


def _text(size: int | None = None, **more) -> dict:
    return {"type": "string", **({"maxLength": size} if size else {}), **more}


def _one_of(*values: str) -> dict:
    return {"type": "string", "enum": list(values)}


# Fixed values of the table contracts.
STATUSES = ("valid", "warning", "error", "pending")
ACCOUNT_TYPES = ("iban", "account_number", "bic", "swift", "other")
COMMUNICATION_TYPES = ("call", "sms", "mms", "email", "voicemail", "data", "other")
PARTY_TYPES = ("msisdn", "email", "imei", "imsi", "ip", "other")
DIRECTIONS = ("outbound", "inbound", "internal", "unknown")
IDENTIFIER_TYPES = ("iban", "msisdn", "email", "bsn", "passport", "kvk", "btw", "other")
TIME, DAY, ID, FLAG, OBJECT = (_text(format="date-time"), _text(format="date"), _text(format="uuid"),
                               {"type": "boolean"}, {"type": "object"})
PERCENT = {"type": "integer", "minimum": 0, "maximum": 100}
MOST_MONEY = 999999999999.99

_ORIGIN = {"source_system_id": _text(50), "source_record_id": _text(100), "source_file_name": _text(255),
           "ingestion_timestamp": TIME, "investigation_id": _text(50)}
_VERDICT = {"validation_status": _one_of(*STATUSES), "validation_messages": OBJECT, "data_completeness_score": PERCENT,
            "source_raw_data": OBJECT, "created_at": TIME, "updated_at": TIME, "created_by": _text(100)}


def _account(side: str) -> dict:
    return {f"{side}_account_id": _text(100), f"{side}_account_type": _one_of(*ACCOUNT_TYPES),
            f"{side}_name": _text(255), f"{side}_bank_code": _text(20)}


def _party(side: str) -> dict:
    return {f"{side}_id": _text(100), f"{side}_type": _one_of(*PARTY_TYPES), f"{side}_name": _text(255),
            f"{side}_location": OBJECT}


TRANSACTION = {
    "required": ["source_system_id", "source_record_id", "investigation_id", "transaction_datetime", "currency_code",
                 "source_raw_data"],
    "additionalProperties": False,
    "properties": {
        "canonical_transaction_id": ID, **_ORIGIN, "transaction_reference": _text(100), "transaction_datetime": TIME,
        "posting_date": DAY, "value_date": DAY,
        "amount": {"type": "number", "minimum": -MOST_MONEY, "maximum": MOST_MONEY},
        "currency_code": _text(pattern="^[A-Z]{3}$"), **_account("debtor"), **_account("creditor"),
        "transaction_type": _one_of(*TRANSACTION_TYPES), "payment_method": _text(50), "description": _text(),
        "reference_number": _text(100), "is_cancelled": FLAG, "is_reversal": FLAG, "related_transaction_id": ID,
        **_VERDICT},
}
COMMUNICATION = {
    "required": ["source_system_id", "source_record_id", "investigation_id", "communication_type",
                 "communication_datetime", "originator_id", "originator_type", "recipient_id", "recipient_type",
                 "source_raw_data"],
    "additionalProperties": False,
    "properties": {
        "canonical_communication_id": ID, **_ORIGIN, "communication_type": _one_of(*COMMUNICATION_TYPES),
        "communication_datetime": TIME, "duration_seconds": {"type": "integer", "minimum": 0}, **_party("originator"),
        **_party("recipient"), "direction": _one_of(*DIRECTIONS), "call_status": _text(20), "location_info": OBJECT,
        "message_content": _text(), "message_subject": _text(500), "attachment_count": {"type": "integer", "minimum": 0},
        "content_hash": _text(64), "network_operator": _text(100), "connection_type": _text(50),
        "cell_tower_id": _text(100), "imei": _text(20), **_VERDICT},
    "allOf": [{"if": {"properties": {"communication_type": {"const": "call"}}},
               "then": {"required": ["duration_seconds"]}}],
}
PERSON = {
    "properties": {
        "person_type": _one_of("natural", "legal", "unknown"), "identifier_type": _one_of(*IDENTIFIER_TYPES),
        "person_role": _one_of("suspect", "victim", "witness", "related", "unknown"),
        "risk_level": _one_of("high", "medium", "low", "unknown"),
        "confidence_score": {"type": "number", "minimum": 0, "maximum": 1}, "data_completeness_pct": PERCENT},
}
CASE = {
    "required": ["name", "start_date"],
    "properties": {
        "name": _text(255, minLength=3), "status": _one_of("active", "closed", "archived"), "start_date": DAY,
        "end_date": DAY, "lead_investigator": _text(100)},
}


def transaction_checks() -> list[Rule]:
    """An amount of zero has no currency, any other amount has one."""
    amount, currency = F.col("amount"), F.col("currency_code")
    return [Rule("check", "amount", amount.isNotNull() & ((amount == 0) == currency.isNotNull()))]


def case_checks() -> list[Rule]:
    return [Rule("check", "end_date", F.col("end_date") < F.col("start_date"))]


# ---- compiler -------------------------------------------------------------------------------


def _holds(condition: Mapping) -> Column:
    """The condition of an ``if``: columns that equal a constant, or are one of several values."""
    out = F.lit(True)
    for name, wanted in condition["properties"].items():
        values = [wanted["const"]] if "const" in wanted else list(wanted["enum"])
        out = out & F.coalesce(F.col(f"`{name}`").isin(*values), F.lit(False))
    return out


def _kinds(spec: Mapping) -> list[str]:
    kinds = spec.get("type", [])
    return [k for k in ([kinds] if isinstance(kinds, str) else kinds) if k != "null"]


def _column_rules(name: str, spec: Mapping) -> list[Rule]:
    quoted, c = f"`{name}`", F.col(f"`{name}`")
    rules = []
    if "minLength" in spec:
        rules.append(Rule("min_length", name, F.length(c) < spec["minLength"]))
    if "maxLength" in spec:
        rules.append(Rule("max_length", name, max_length(quoted, spec["maxLength"])))
    if "pattern" in spec:
        rules.append(Rule("pattern", name, regex(quoted, spec["pattern"])))
    if spec.get("format") == "uuid":
        rules.append(Rule("uuid", name, regex(quoted, UUID)))
    if values := [v for v in spec.get("enum", ()) if v is not None]:
        rules.append(Rule("enum", name, accepted_values(quoted, values)))
    if "minimum" in spec:
        rules.append(Rule("minimum", name, c < F.lit(spec["minimum"])))
    if "maximum" in spec:
        rules.append(Rule("maximum", name, c > F.lit(spec["maximum"])))
    return rules


def compile_contract(contract: Mapping) -> list[Rule]:
    """A rule for each declared requirement, length, pattern, enumeration and bound.

    Null passes every rule but ``required``: a null stands for an absent property.
    """
    rules = [Rule("required", c, not_null(f"`{c}`")) for c in contract.get("required", ())]
    for name, spec in contract.get("properties", {}).items():
        rules += _column_rules(name, spec)
    for clause in contract.get("allOf", ()):
        rules += [Rule("required_if", c, _holds(clause["if"]) & not_null(f"`{c}`"))
                  for c in clause.get("then", {}).get("required", ())]
    return rules


def shape_findings(df: DataFrame, contract: Mapping) -> list[tuple[str, str]]:
    """Required columns that are absent, columns of another type, and columns no property declares."""
    have, declared = dict(df.dtypes), contract.get("properties", {})
    found = [("missing_column", c) for c in contract.get("required", ()) if c not in have]
    for name, spec in declared.items():
        base = have.get(name, "void").split("<")[0].split("(")[0]
        wanted = _kinds(spec)
        allowed = [t for k in wanted for t in CARRIERS[spec["format"] if k == "string" and spec.get("format") in CARRIERS else k]]
        if base != "void" and allowed and base not in allowed:
            found.append(("type", name))
    if contract.get("additionalProperties", True) is False:
        found += [("extra_column", c) for c in have if c not in declared]
    return found


def contract_check(df: DataFrame, contract: Mapping, checks: list[Rule] | None = None) -> DataFrame:
    """Every rule of a contract with its failing rows: rule, column, checked, failed, passed.

    One aggregation counts all rules. A declared column the table lacks counts as null in each row.
    Findings about the columns themselves follow as rows of one checked and one failed. ``checks`` adds
    rules over several columns. An empty table fails only what its columns fail.
    """
    rules = compile_contract(contract) + list(checks or ())
    absent = [c for c in contract.get("properties", {}) if c not in df.columns]
    absent += [c for c in contract.get("required", ()) if c not in df.columns and c not in absent]
    full = df.withColumns({c: F.lit(None).cast("string") for c in absent}) if absent else df
    parts = []
    if rules:
        parts.append(check_rows(full, rules))
    if found := shape_findings(df, contract):
        rows = [F.struct(F.lit(r).alias("rule"), F.lit(c).alias("column"), F.lit(1).cast("bigint").alias("checked"),
                         F.lit(1).cast("bigint").alias("failed"), F.lit(False).alias("passed")) for r, c in found]
        parts.append(df.sparkSession.range(1).select(F.inline(F.array(*rows))))
    if not parts:
        raise ValueError("the contract declares nothing")
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part)
    return out
