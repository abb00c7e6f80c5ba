"""Raw rows to validated canonical transactions and communications."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, functions as F

from ..functions import dates, iban, phone, text

# Fixed values.
TRANSACTION_REQUIRED = ("source_system_id", "source_record_id", "investigation_id", "transaction_datetime",
                        "currency_code")
COMMUNICATION_REQUIRED = ("source_system_id", "source_record_id", "investigation_id", "communication_type",
                          "communication_datetime", "originator_id", "recipient_id")
TRANSACTION_TYPES = ("debit", "credit", "transfer", "payment", "withdrawal", "deposit", "fee", "interest", "other")
COMPLETENESS_FIELDS = ("transaction_datetime", "amount", "currency_code", "debtor_account_id",
                       "creditor_account_id", "description", "reference_number", "debtor_name", "creditor_name")
DIRECTIONS = {"incoming": "inbound", "outgoing": "outbound", "missed": "inbound", "internal": "internal"}
CONTENT_TYPES = ("sms", "email", "mms")
LARGE_AMOUNT = 1000000
LONGEST_CALL = 86400
OPERATOR = "telecom_a"

BANK_JSON = ("iban string, tegenrekening_iban string, referentie string, tijd string, valutadatum string, "
             "naam_van string, naam_naar string, kenmerk string, source_file string, is_storno string")
CALL_JSON = ("caller string, callee string, call_date string, call_time string, duration_seconds string, "
             "call_type string, network_type string, source_file string")
SMS_JSON = "sender string, recipient string, timestamp string, message_text string, content string, source_file string"


def empty(c: Column, kind: str = "string") -> Column:
    """Null, and for text also the empty string, for numbers zero, for flags false."""
    blank = {"string": c == "", "boolean": ~c}.get(kind)
    if blank is None and (kind.startswith("decimal") or kind in ("int", "bigint", "double")):
        blank = c == 0
    return c.isNull() if blank is None else c.isNull() | blank


def completeness(df: DataFrame, fields=COMPLETENESS_FIELDS) -> Column:
    """Share of filled fields in whole percent."""
    kinds = dict(df.dtypes)
    filled = sum((F.when(empty(F.col(f), kinds[f]), 0).otherwise(1) for f in fields), F.lit(0))
    return F.floor(filled * 100 / F.lit(len(fields))).cast("int")


def _sibling(c: Column) -> Column:
    return F.when(F.length(c) > 0, c)


def load_raw(df: DataFrame, columns: dict[str, Column]) -> DataFrame:
    """The raw table row: chosen columns, and the whole input row as JSON."""
    return df.select(*[c.alias(name) for name, c in columns.items()],
                     F.to_json(F.struct(*df.columns)).alias("raw_data"))


def raw_transactions(df: DataFrame) -> DataFrame:
    col = F.col
    return load_raw(df, {
        "transaction_id": col("transaction_id"), "investigation_id": col("investigation_id"),
        "source_id": col("source_id"), "iban_from": col("iban"), "iban_to": col("tegenrekening_iban"),
        "bedrag": col("bedrag"), "datum": col("datum"), "omschrijving": col("omschrijving")})


def raw_calls(df: DataFrame) -> DataFrame:
    col = F.col
    return load_raw(df, {
        "call_id": col("call_id"), "investigation_id": col("investigation_id"), "source_id": col("source_id"),
        "caller_number": col("caller"), "called_number": col("callee"), "call_date": col("call_date"),
        "call_time": col("call_time"), "duration_seconds": col("duration_seconds"), "call_type": col("call_type")})


def raw_messages(df: DataFrame) -> DataFrame:
    col = F.col
    return load_raw(df, {
        "message_id": col("message_id"), "investigation_id": col("investigation_id"), "source_id": col("source_id"),
        "sender_number": col("sender"), "recipient_number": col("recipient"),
        "message_text": col("message_text"), "message_type": F.lit("sms")})


def computed_once(df: DataFrame) -> DataFrame:
    """The same rows, with every column computed before the next step.

    The optimiser puts a projection into each expression above it that uses it; where rules on derived
    columns follow, the plan multiplies with every step. It doesn't do so through a generator.
    """
    return df.select(F.inline(F.array(F.struct(*[F.col(f"`{c}`") for c in df.columns]))))


def map_transactions(raw: DataFrame, description_length: int | None = None) -> DataFrame:
    """Raw bank rows in canonical columns, not yet validated; descriptions whole unless a length is given."""
    j = F.from_json("raw_data", BANK_JSON)
    r = raw.withColumn("j", j)
    day = F.col("datum").cast("string")
    debtor, creditor = _sibling(F.col("j.iban")), _sibling(F.col("j.tegenrekening_iban"))
    has_debtor = debtor.isNotNull() & ~text.is_numeric(debtor)
    is_atm = F.upper(creditor) == "ATM"
    amount = F.col("bedrag")
    mapped = r.select(
        F.col("source_id").alias("source_system_id"),
        F.col("transaction_id").cast("string").alias("source_record_id"),
        F.col("j.source_file").alias("source_file_name"),
        "investigation_id",
        F.col("j.referentie").alias("transaction_reference"),
        dates.dutch_datetime(day, F.col("j.tijd")).alias("transaction_datetime"),
        dates.dutch_date(day).cast("date").alias("posting_date"),
        dates.dutch_date(F.coalesce(F.col("j.valutadatum"), day)).cast("date").alias("value_date"),
        amount.alias("amount"),
        F.lit("EUR").alias("currency_code"),
        F.when(has_debtor, iban.normalize(debtor)).alias("debtor_account_id"),
        F.when(has_debtor, F.lit("iban")).alias("debtor_account_type"),
        F.col("j.naam_van").alias("debtor_name"),
        F.when(is_atm, F.lit("ATM")).otherwise(iban.normalize(creditor)).alias("creditor_account_id"),
        F.when(is_atm, F.lit("atm")).when(creditor.isNotNull(), F.lit("iban")).alias("creditor_account_type"),
        F.col("j.naam_naar").alias("creditor_name"),
        F.when(amount > 0, "credit").when(amount < 0, "debit").otherwise("other").alias("transaction_type"),
        F.lit("wire").alias("payment_method"),
        text.clean_description(F.col("omschrijving"), description_length).alias("description"),
        F.col("j.kenmerk").alias("reference_number"),
        F.lit(False).alias("is_cancelled"),
        F.coalesce(F.lower("j.is_storno") == "true", F.lit(False)).alias("is_reversal"),
        F.col("raw_data").alias("source_raw_data"))
    mapped = computed_once(mapped)
    return mapped.withColumn("data_completeness_score", completeness(mapped))


def _communication(raw: DataFrame, record_id: str, kind: str, fields: dict[str, Column]) -> DataFrame:
    shared = {
        "source_system_id": F.col("source_id"),
        "source_record_id": F.col(record_id).cast("string"),
        "source_file_name": F.col("j.source_file"),
        "investigation_id": F.col("investigation_id"),
        "communication_type": F.lit(kind),
        "originator_type": F.lit("msisdn"),
        "recipient_type": F.lit("msisdn"),
        "network_operator": F.lit(OPERATOR),
        "source_raw_data": F.col("raw_data"),
    }
    return computed_once(raw.select(*[c.alias(n) for n, c in {**shared, **fields}.items()]))


def map_calls(raw: DataFrame) -> DataFrame:
    r = raw.withColumn("j", F.from_json("raw_data", CALL_JSON))
    day = F.coalesce(F.col("call_date"), F.col("j.call_date"))
    clock = F.coalesce(F.col("call_time"), F.col("j.call_time"))
    ways = F.create_map(*[F.lit(x) for pair in DIRECTIONS.items() for x in pair])
    return _communication(r, "call_id", "call", {
        "communication_datetime": dates.call_datetime(day, clock),
        "duration_seconds": F.coalesce(F.col("j.duration_seconds").try_cast("int"), F.lit(0)),
        "originator_id": phone.e164(F.col("j.caller")),
        "recipient_id": phone.e164(F.col("j.callee")),
        "direction": F.coalesce(F.try_element_at(ways, F.lower("j.call_type")), F.lit("unknown")),
        "call_status": F.when(F.lower("j.call_type") == "missed", "missed").otherwise("completed"),
        "connection_type": F.col("j.network_type"),
        "message_content": F.lit(None).cast("string"),
        "content_hash": F.lit(None).cast("string")})


def map_messages(raw: DataFrame) -> DataFrame:
    r = raw.withColumn("j", F.from_json("raw_data", SMS_JSON))
    content = F.coalesce(_sibling(F.col("j.message_text")), F.col("j.content"))
    return _communication(r, "message_id", "sms", {
        "communication_datetime": dates.from_millis(F.col("j.timestamp").try_cast("bigint")),
        "duration_seconds": F.lit(None).cast("int"),
        "originator_id": phone.e164(F.col("j.sender")),
        "recipient_id": phone.e164(F.col("j.recipient")),
        "direction": F.lit("outbound"),
        "call_status": F.lit(None).cast("string"),
        "connection_type": F.lit(None).cast("string"),
        "message_content": content,
        "content_hash": F.when(F.length(content) > 0, F.sha2(content, 256))})


def _notes(rules) -> Column:
    """The texts of the rules that hold, in order."""
    return F.filter(F.array(*[F.when(cond, note) for cond, note in rules]), lambda x: x.isNotNull())


def _missing(df: DataFrame, fields):
    kinds = dict(df.dtypes)
    return [(empty(F.col(f), kinds[f]), F.lit(f"Missing required field: {f}")) for f in fields]


def _with_status(df: DataFrame, errors, warnings) -> DataFrame:
    status = (F.when(F.size("validation_errors") > 0, "error")
              .when(F.size("validation_warnings") > 0, "warning").otherwise("valid"))
    noted = df.withColumns({"validation_errors": _notes(errors), "validation_warnings": _notes(warnings)})
    return computed_once(noted).withColumn("validation_status", status)


def _say(prefix: str, c: Column, suffix: str = "") -> Column:
    return F.concat(F.lit(prefix), F.coalesce(c.cast("string"), F.lit("None")), F.lit(suffix))


def validate_transactions(df: DataFrame, as_of: dt.datetime) -> DataFrame:
    col = F.col
    debtor, creditor, amount = col("debtor_account_id"), col("creditor_account_id"), col("amount")
    errors = _missing(df, TRANSACTION_REQUIRED) + [
        ((col("debtor_account_type") == "iban") & ~empty(debtor) & ~iban.valid_loose(debtor),
         _say("Invalid debtor IBAN format: ", debtor)),
        ((col("creditor_account_type") == "iban") & ~empty(creditor) & ~iban.valid_loose(creditor),
         _say("Invalid creditor IBAN format: ", creditor)),
        (empty(debtor) & empty(creditor), F.lit("Transaction must have at least one account (debtor or creditor)")),
    ]
    when = col("transaction_datetime")
    warnings = [
        (amount.isNull(), F.lit("Amount is NULL - transaction may be incomplete")),
        (amount == 0, F.lit("Zero amount transaction")),
        (F.abs(amount) > LARGE_AMOUNT, _say("Large amount: ", amount)),
        (col("creditor_account_type") == "atm", F.lit("ATM transaction without creditor IBAN")),
        (~empty(col("currency_code")) & ~text.valid_currency(col("currency_code")),
         _say("Non-standard currency code: ", col("currency_code"))),
        (~empty(col("transaction_type")) & ~col("transaction_type").isin(*TRANSACTION_TYPES),
         _say("Non-standard transaction type: ", col("transaction_type"))),
        (when > F.lit(as_of).cast(dates.NTZ), _say("Future transaction datetime: ", when)),
    ]
    return _with_status(df, errors, warnings)


def validate_communications(df: DataFrame) -> DataFrame:
    col = F.col
    seconds, is_call = col("duration_seconds"), col("communication_type") == "call"
    errors = _missing(df, COMMUNICATION_REQUIRED) + [
        (is_call & seconds.isNull(), F.lit("Call records must have duration_seconds")),
        (is_call & (seconds < 0), _say("Negative duration: ", seconds)),
    ]
    warnings = [(is_call & (seconds > LONGEST_CALL), _say("Very long call duration: ", seconds, "s"))]
    for side in ("originator", "recipient"):
        number = col(f"{side}_id")
        warnings.append(((col(f"{side}_type") == "msisdn") & ~phone.valid_e164(number),
                         _say("Non-standard phone format: ", number)))
    warnings.append((col("communication_type").isin(*CONTENT_TYPES) & empty(col("message_content")),
                     F.lit("Message records should have content")))
    return _with_status(df, errors, warnings)


def canonical_transactions(raw: DataFrame, as_of: dt.datetime, description_length: int | None = None) -> DataFrame:
    return validate_transactions(map_transactions(raw, description_length), as_of)


def canonical_communications(calls: DataFrame, messages: DataFrame) -> DataFrame:
    return validate_communications(map_calls(calls).unionByName(map_messages(messages)))


def unmapped(raw: DataFrame, canonical: DataFrame, record_id: str) -> DataFrame:
    """Raw rows without a canonical row."""
    done = canonical.select(F.col("source_system_id").alias("source_id"), F.col("source_record_id").alias(record_id))
    return raw.join(done, ["source_id", record_id], "left_anti").select(*raw.columns)


def unmapped_counts(pairs: dict[str, tuple[DataFrame, DataFrame, str]]) -> DataFrame:
    """Open rows per record kind: ``kind → (raw, canonical, record id)``."""
    parts = [unmapped(raw, canon, rid).agg(F.count("*").alias("unmapped")).select(F.lit(kind).alias("kind"), "unmapped")
             for kind, (raw, canon, rid) in pairs.items()]
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part)
    return out
