"""File intake: type detection, routing, status, ids."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, functions as F

from .keyed import last_known, new_ids


@dataclass(frozen=True)
class FileType:
    name: str
    patterns: tuple[str, ...]
    keywords: tuple[str, ...]
    output: str
    pipeline: str | None


# Types in order of preference. A pattern ends in its own extensions.
FILE_TYPES = (
    FileType("bank_transactions", (r"(transacti|mutaties|rekening|bank).*\.csv$",),
             ("iban", "bedrag", "tegenrekening", "saldo", "valutadatum"), "transaction", "bank_transaction_pipeline"),
    FileType("call_records", (r"(call|bel|gesprek|telecom).*\.csv$",),
             ("caller", "callee", "duration", "cell_tower", "imei", "imsi"), "call_record", "telecom_call_pipeline"),
    FileType("sms_records", (r"(sms|message|berichten).*\.csv$",),
             ("sender", "recipient", "message", "timestamp", "phone"), "message", "telecom_call_pipeline"),
    FileType("whatsapp_export", (r"whatsapp.*\.(txt|csv|json)$", r"chat.*export.*\.(txt|csv)$"),
             ("whatsapp", "chat", "message", "timestamp"), "message", "whatsapp_processing_pipeline"),
    FileType("forensic_metadata", (r"(metadata|filesystem|forensic).*\.json$",),
             ("file_path", "created_time", "modified_time", "hash"), "file_metadata", "forensic_metadata_pipeline"),
    FileType("social_media", (r"(facebook|instagram|twitter|social).*\.json$",),
             ("posts", "friends", "messages", "profile"), "social_media", "social_media_pipeline"),
)
JSON_HEAD = 1024  # the reference looks for keywords of a JSON file in this many leading characters
MIN_KEYWORDS = 2


def _choose(pairs, otherwise=None) -> Column:
    pairs = list(pairs)
    rule = F.when(pairs[0][0], pairs[0][1])
    for cond, value in pairs[1:]:
        rule = rule.when(cond, value)
    return rule if otherwise is None else rule.otherwise(otherwise)


def detect_file_types(files: DataFrame, json_head: int | None = None) -> DataFrame:
    """Type by file name, else by two keywords in the head, else unknown.

    ``files``: file_name and head (the text the file starts with). Of a JSON file the whole head is
    searched, or its first ``json_head`` characters (JSON_HEAD for the reference's rule).
    """
    name = F.lower("file_name")
    first_line = F.lower(F.split_part("head", F.lit("\n"), F.lit(1)))
    start = F.lower("head" if json_head is None else F.substring("head", 1, json_head))
    is_csv, is_json = name.endswith(".csv"), name.endswith(".json")
    text = F.when(is_csv, first_line).when(is_json, start)

    def by_name(t):
        hit = F.lit(False)
        for p in t.patterns:
            hit = hit | name.rlike(p)
        return hit

    def by_head(t):
        found = sum((text.contains(k).cast("int") for k in t.keywords), F.lit(0))
        return F.coalesce(found >= MIN_KEYWORDS, F.lit(False))

    named = _choose((by_name(t), F.lit(t.name)) for t in FILE_TYPES)
    guessed = _choose((by_head(t), F.lit(t.name)) for t in FILE_TYPES)
    typed = files.withColumns({"_named": named, "_guessed": guessed})
    kind = F.coalesce("_named", "_guessed", F.lit("unknown"))
    level = F.when(F.col("_named").isNotNull(), "high").when(F.col("_guessed").isNotNull(), "medium").otherwise("none")
    out = typed.withColumns({"file_type": kind, "confidence": level}).drop("_named", "_guessed")
    return out.withColumns({
        "pipeline": _choose((F.col("file_type") == t.name, F.lit(t.pipeline)) for t in FILE_TYPES),
        "output_type": _choose((F.col("file_type") == t.name, F.lit(t.output)) for t in FILE_TYPES)})


def intake_triage(files: DataFrame) -> DataFrame:
    """How many files go on and how many are set aside, per type."""
    found = detect_file_types(files)
    status = F.when(F.col("file_type") == "unknown", "skipped").otherwise("detected")
    return found.groupBy(status.alias("status"), "file_type").agg(F.count("*").alias("count"))


def file_status(events: DataFrame) -> DataFrame:
    """Current state of each file after its status events.

    ``events``: source_id, seq, event_time, status, pipeline, error_message, in
    order of time and seq. ``processing`` sets the start, ``completed`` and
    ``failed`` the end; the last pipeline named stays; ``retry`` resets all else
    and is refused while the file is completed.
    """
    order = ["event_time", "seq"]
    state = F.when(F.col("status") != "retry", F.col("status"))
    seen = last_known(events.withColumn("_state", state), "source_id", order, "_state", "_before",
                      F.date_trunc("day", "event_time"))
    status, at = F.col("status"), F.struct(*order, "status", "pipeline", "error_message")
    reset = (status == "retry") & (F.coalesce("_before", F.lit("")) != "completed")
    newest = lambda cond: F.max(F.when(cond, at))
    folded = seen.groupBy("source_id").agg(
        newest(reset).alias("r"), newest(status != "retry").alias("l"), newest(status == "processing").alias("s"),
        newest(status.isin("completed", "failed")).alias("e"), newest(F.col("pipeline").isNotNull()).alias("p"))

    def after_reset(event, field):
        live = F.col("r").isNull() | (F.struct(*[f"{event}.{c}" for c in order]) > F.struct(*[f"r.{c}" for c in order]))
        return F.when(live, F.col(f"{event}.{field}"))

    return folded.select(
        "source_id", F.coalesce(after_reset("l", "status"), F.lit("pending")).alias("processing_status"),
        after_reset("s", "event_time").alias("started_at"), after_reset("e", "event_time").alias("completed_at"),
        F.col("p.pipeline").alias("pipeline"), after_reset("l", "error_message").alias("error_message"))


def assign_case_ids(requests: DataFrame, cases: DataFrame) -> DataFrame:
    """``OND-year-number`` for new cases, numbered on from the highest of the year.

    ``requests``: request_id, created_at.
    """
    year = F.year("created_at")
    parsed = F.regexp_extract_all("investigation_id", F.lit(r"^OND-(\d{4})-(\d+)$"))
    known = (cases.where(F.size(parsed) > 0)
             .groupBy(F.split_part("investigation_id", F.lit("-"), F.lit(2)).cast("int").alias("year"))
             .agg(F.max(F.split_part("investigation_id", F.lit("-"), F.lit(3)).cast("bigint")).alias("highest")))
    numbered = new_ids(requests.withColumn("year", year), known, "year", ["created_at", "request_id"],
                       F.date_trunc("day", "created_at"))
    width = F.greatest(F.lit(6), F.length(F.col("number").cast("string")))
    return numbered.select("request_id", F.concat_ws(
        "-", F.lit("OND"), F.col("year").cast("string"), F.lpad(F.col("number").cast("string"), width, F.lit("0")),
    ).alias("investigation_id"))


def assign_source_ids(requests: DataFrame, files: DataFrame) -> DataFrame:
    """``SRC-case-number`` for new files of each case; ``requests``: request_id, investigation_id, created_at."""
    last = F.regexp_extract("source_id", r"([0-9]+)$", 1).try_cast("bigint")
    known = files.groupBy("investigation_id").agg(F.max(last).alias("highest"))
    numbered = new_ids(requests, known, "investigation_id", ["created_at", "request_id"],
                       F.date_trunc("day", "created_at"))
    case = F.col("investigation_id").substr(F.lit(5), F.length("investigation_id"))
    width = F.greatest(F.lit(3), F.length(F.col("number").cast("string")))
    return numbered.select("request_id", "investigation_id", F.concat_ws(
        "-", F.lit("SRC"), case, F.lpad(F.col("number").cast("string"), width, F.lit("0"))).alias("source_id"))


def route_backfill(files: DataFrame) -> DataFrame:
    """Target raw table and source of processed rows by their file path (``path`` column)."""
    table = (F.when(F.col("path").contains("/transactions/"), "raw_transactions")
             .when(F.col("path").contains("/call_records/"), "raw_calls")
             .when(F.col("path").contains("/messages/"), "raw_messages"))
    name = F.element_at(F.split("path", "/"), -1)
    guess = F.nullif(F.regexp_extract(name, "^([^_]+)_", 1), F.lit(""))
    source = F.coalesce("source_id", guess) if "source_id" in files.columns else guess
    case = F.nullif(F.regexp_extract("path", "(OND-[^/]+)", 1), F.lit(""))
    return files.withColumns({"target_table": table, "source_id": source,
                              "investigation_id": F.coalesce("investigation_id", case)
                              if "investigation_id" in files.columns else case})
