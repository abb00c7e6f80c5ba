"""Per-case analytics, register reports and searches."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, functions as F

CASE = "investigation_id"


def page(df: DataFrame, limit: int | None, offset: int = 0, most: int | None = None) -> DataFrame:
    """One page of an ordered result; no limit gives all rows. A bound out of range is an error."""
    if offset < 0 or (limit is not None and (limit < 1 or (most is not None and limit > most))):
        raise ValueError(f"limit {limit} (1 to {most or 'any'}) or offset {offset} is out of range")
    df = df.offset(offset) if offset else df
    return df if limit is None else df.limit(limit)


# ---- per account, pair and day --------------------------------------------------------------


def iban_summary(tx: DataFrame) -> DataFrame:
    amount = F.col("bedrag")
    zero = F.lit(0).cast("decimal(15,2)")
    return tx.groupBy(CASE, "iban").agg(
        F.count("*").alias("total_transactions"),
        F.sum(F.when(amount < 0, amount).otherwise(zero)).alias("total_debit"),
        F.sum(F.when(amount > 0, amount).otherwise(zero)).alias("total_credit"),
        F.sum(amount).alias("net_amount"), F.min("datum").alias("first_transaction"),
        F.max("datum").alias("last_transaction"), F.count_distinct(F.to_date("datum")).alias("active_days"),
    ).orderBy(F.abs("net_amount").desc(), CASE, "iban")


def call_network(calls: DataFrame) -> DataFrame:
    return calls.groupBy(CASE, "caller", "callee").agg(
        F.count("*").alias("call_count"), F.sum("duration_seconds").alias("total_duration_seconds"),
        F.avg("duration_seconds").alias("avg_duration_seconds"), F.min("timestamp").alias("first_call"),
        F.max("timestamp").alias("last_call"))


def message_network(messages: DataFrame) -> DataFrame:
    return messages.groupBy(CASE, "sender", "recipient").agg(
        F.count("*").alias("message_count"), F.min("timestamp").alias("first_message"),
        F.max("timestamp").alias("last_message"))


def daily_activity(tx: DataFrame | None = None, calls: DataFrame | None = None,
                   messages: DataFrame | None = None) -> DataFrame:
    """Activity of the three record kinds side by side per case and day.

    The kinds are stacked and summed in one shuffle. Rows without a date stay
    apart per kind. A kind that is missing counts zero.
    """
    measures = {"transaction_count": "bigint", "total_amount": "decimal(15,2)", "call_count": "bigint",
                "total_call_duration": "bigint", "message_count": "bigint"}

    def part(df, day, kind, filled):
        cols = [filled.get(m, F.lit(0)).cast(t).alias(m) for m, t in measures.items()]
        date = F.to_date(day)
        return df.select(CASE, date.alias("date"), F.when(date.isNull(), kind).alias("_kind"), *cols)

    parts = []
    if tx is not None:
        parts.append(part(tx, "datum", "t", {"transaction_count": F.lit(1), "total_amount": F.col("bedrag")}))
    if calls is not None:
        parts.append(part(calls, "timestamp", "c", {"call_count": F.lit(1),
                                                    "total_call_duration": F.col("duration_seconds")}))
    if messages is not None:
        parts.append(part(messages, "timestamp", "m", {"message_count": F.lit(1)}))
    if not parts:
        raise ValueError("no activity data given")
    stacked = parts[0]
    for more in parts[1:]:
        stacked = stacked.unionByName(more)
    sums = [F.coalesce(F.sum(m), F.lit(0)).alias(m) for m in measures]
    return stacked.groupBy(CASE, "date", "_kind").agg(*sums).drop("_kind")


def _distinct_count(df: DataFrame, columns: list[str], out: str) -> DataFrame:
    """Distinct values of several columns per case; null is no value."""
    each = df.select(CASE, F.explode(F.array(*columns)).alias("v")).distinct()
    return each.groupBy(CASE).agg(F.count("v").alias(out))


def case_stats(cases: DataFrame, daily: DataFrame, ibans: DataFrame, calls: DataFrame,
               messages: DataFrame) -> DataFrame:
    """Totals of each active case over the day, account and network summaries."""
    out = cases.where("status = 'active'").select(CASE, F.col("name").alias("investigation_name"))
    parts = [
        daily.groupBy(CASE).agg(
            F.sum("transaction_count").alias("total_transactions"),
            F.sum("total_amount").alias("total_transaction_amount"), F.min("date").alias("first_activity_date"),
            F.max("date").alias("last_activity_date"), F.count_distinct("date").alias("active_days")),
        ibans.groupBy(CASE).agg(F.count_distinct("iban").alias("unique_ibans")),
        calls.groupBy(CASE).agg(F.sum("call_count").alias("total_calls"),
                                (F.sum("total_duration_seconds") / 3600).alias("total_call_duration_hours")),
        _distinct_count(calls, ["caller", "callee"], "unique_phone_numbers"),
        messages.groupBy(CASE).agg(F.sum("message_count").alias("total_messages")),
        _distinct_count(messages, ["sender", "recipient"], "unique_message_participants"),
    ]
    for part in parts:
        out = out.join(part, CASE, "left")
    counts = [c for c in out.columns if c not in (CASE, "investigation_name") and "_date" not in c]
    return out.na.fill(0, subset=counts)


def case_analytics(cases: DataFrame, stats: DataFrame) -> DataFrame:
    """Stored totals of every case; a case not yet processed reads as zeros."""
    numbers = [c for c in stats.columns if c not in (CASE, "investigation_name") and "_date" not in c]
    return cases.select(CASE).join(stats.drop("investigation_name"), CASE, "left").na.fill(0, subset=numbers)


def case_totals(ibans: DataFrame, calls: DataFrame) -> DataFrame:
    money = ibans.groupBy(CASE).agg(
        F.count("*").alias("total_ibans"), F.sum("total_transactions").alias("total_transactions"),
        F.sum("total_debit").alias("total_debit"), F.sum("total_credit").alias("total_credit"),
        F.sum("net_amount").alias("net_amount"))
    talk = calls.groupBy(CASE).agg(
        F.count("*").alias("total_call_pairs"), F.sum("call_count").alias("total_calls"),
        (F.sum("total_duration_seconds") / 3600).alias("total_duration_hours"))
    return money.join(talk, CASE, "full_outer")


# ---- register reports -----------------------------------------------------------------------


def case_summary(cases: DataFrame, files: DataFrame, records: DataFrame) -> DataFrame:
    """Files, records and bytes per case; each side is summed before the join."""
    state = F.col("processing_status")
    by_file = files.groupBy(CASE).agg(
        F.count_distinct("source_id").alias("total_files"),
        F.count_distinct(F.when(state == "completed", F.col("source_id"))).alias("processed_files"),
        F.count_distinct(F.when(state == "failed", F.col("source_id"))).alias("failed_files"),
        F.sum("file_size_bytes").alias("total_storage_bytes"), F.max("received_date").alias("last_file_received"))
    by_record = records.groupBy(CASE).agg(F.count_distinct("record_id").alias("total_records"))
    return (cases.select(CASE, "name", "status", "start_date", "lead_investigator")
            .join(by_file, CASE, "left").join(by_record, CASE, "left")
            .na.fill(0, subset=["total_files", "processed_files", "failed_files", "total_records"]))


def case_record_counts(cases: DataFrame, tx: DataFrame, calls: DataFrame, messages: DataFrame) -> DataFrame:
    """Distinct records of three kinds per case, counted together."""
    kinds = {"transaction": (tx, "transaction_id"), "call": (calls, "call_id"), "message": (messages, "message_id")}
    parts = [df.select(CASE, F.lit(kind).alias("kind"), F.col(rid).alias("rid")) for kind, (df, rid) in kinds.items()]
    stacked = parts[0].unionByName(parts[1]).unionByName(parts[2]).where("rid IS NOT NULL").distinct()
    counts = stacked.groupBy(CASE).agg(*[F.count_if(F.col("kind") == k).alias(f"{k}_count") for k in kinds])
    return cases.select(CASE, "name", "status").join(counts, CASE, "left").na.fill(
        0, subset=[f"{k}_count" for k in kinds])


def processing_status_overview(files: DataFrame) -> DataFrame:
    took = F.unix_micros(F.col("processing_completed_at").cast("timestamp")) - F.unix_micros(
        F.col("processing_started_at").cast("timestamp"))
    return files.groupBy(CASE, "source_type", "processing_status").agg(
        F.count("*").alias("count"), F.sum("file_size_bytes").alias("total_bytes"),
        F.avg(took / 1e6).alias("avg_processing_seconds"))


def status_overview_map(files: DataFrame, case: str | None = None) -> DataFrame:
    """Per type a map from status to its counts; at most one entry per status."""
    rows = files if case is None else files.where(F.col(CASE) == case)
    per = rows.groupBy("source_type", "processing_status").agg(
        F.count("*").alias("count"), F.sum("file_size_bytes").alias("total_bytes"))
    entry = F.struct("processing_status", F.struct("count", "total_bytes"))
    return per.groupBy("source_type").agg(
        F.map_from_entries(F.array_sort(F.collect_list(entry))).alias("statuses"))


def transaction_source_summary(canonical: DataFrame) -> DataFrame:
    state = F.col("validation_status")
    return canonical.groupBy("source_system_id", CASE).agg(
        F.count("*").alias("total_transactions"),
        *[F.count_if(state == s).alias(f"{s}_count") for s in ("valid", "warning", "error")],
        F.round(F.avg("data_completeness_score"), 2).alias("avg_completeness"),
        F.min("transaction_datetime").alias("first_transaction"),
        F.max("transaction_datetime").alias("last_transaction"), F.sum("amount").alias("total_amount"))


def bank_file_summary(tx: DataFrame) -> DataFrame:
    return tx.groupBy(CASE, "source_id").agg(
        F.count("*").alias("total_records"), F.coalesce(F.sum("bedrag"), F.lit(0)).alias("total_amount"),
        F.min("datum").alias("first_date"), F.max("datum").alias("last_date"),
        F.count_distinct("iban").alias("unique_ibans"))


def call_file_summary(calls: DataFrame) -> DataFrame:
    return calls.groupBy(CASE, "source_id").agg(
        F.count("*").alias("total_calls"), F.count_distinct("caller").alias("unique_callers"),
        F.count_distinct("callee").alias("unique_callees"),
        (F.coalesce(F.sum("duration_seconds"), F.lit(0)) / 60).alias("total_duration_minutes"),
        F.min("timestamp").alias("first_timestamp"), F.max("timestamp").alias("last_timestamp"))


def message_file_summary(messages: DataFrame) -> DataFrame:
    return messages.groupBy(CASE, "source_id").agg(
        F.count("*").alias("total_messages"), F.count_distinct("sender").alias("unique_senders"),
        F.count_distinct("recipient").alias("unique_recipients"),
        F.min("timestamp").alias("first_timestamp"), F.max("timestamp").alias("last_timestamp"))


def summary_index(summary: DataFrame, record_type: str, prefix: str) -> DataFrame:
    """One index row per file: its type, path and the summary as JSON."""
    facts = [c for c in summary.columns if c not in (CASE, "source_id")]
    return summary.select(
        F.md5(F.concat_ws("|", F.lit(record_type), CASE, "source_id")).alias("record_id"), CASE, "source_id",
        F.lit(record_type).alias("record_type"),
        F.concat_ws("/", CASE, F.lit("processed"), F.lit(prefix), "source_id").alias("path"),
        F.to_json(F.struct(*facts)).alias("summary"))


def new_rows_since(canonical: DataFrame, at: str, cursor: dt.datetime) -> DataFrame:
    fresh = canonical.where((F.col(at) > F.lit(cursor).cast("timestamp_ntz"))
                            & F.col("validation_status").isin("valid", "warning"))
    return fresh.agg(F.count("*").alias("new_count"), F.max(at).alias("latest_time"))


def _stacked_counts(tables: dict[str, DataFrame]) -> DataFrame:
    parts = [df.agg(F.count("*").alias("row_count")).select(F.lit(n).alias("table_name"), "row_count")
             for n, df in tables.items()]
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part)
    return out


def table_counts(tables: dict[str, DataFrame]) -> DataFrame:
    return _stacked_counts(tables)


def layer_reconcile(layers: dict[str, tuple[DataFrame, DataFrame]]) -> DataFrame:
    """Rows of the staging and fact table per layer and how many are still to come."""
    tables = {f"{n}|{side}": df for n, pair in layers.items() for side, df in zip(("staging", "fact"), pair)}
    name = F.split("table_name", r"\|")
    counted = _stacked_counts(tables).select(name[0].alias("layer"), name[1].alias("side"), "row_count")
    sums = counted.groupBy("layer").agg(*[
        F.sum(F.when(F.col("side") == s, F.col("row_count")).otherwise(0)).alias(f"{s}_count")
        for s in ("staging", "fact")])
    return sums.withColumn("new_count", F.col("staging_count") - F.col("fact_count"))


# ---- searches -------------------------------------------------------------------------------


def _in_period(df: DataFrame, column: str, start, end) -> DataFrame:
    if start is not None:
        df = df.where(F.col(column) >= F.lit(start))
    if end is not None:
        df = df.where(F.col(column) <= F.lit(end))
    return df


def search_transactions(tx: DataFrame, case: str | None = None, start_date=None, end_date=None, min_amount=None,
                        iban: str | None = None) -> DataFrame:
    out = tx if case is None else tx.where(F.col(CASE) == case)
    out = _in_period(out, "datum", start_date, end_date)
    if min_amount is not None:
        out = out.where(F.abs("bedrag") >= min_amount)
    if iban is not None:
        out = out.where(F.col("iban") == iban)
    return out.orderBy("datum", "transaction_id")


def _search_contacts(df: DataFrame, sides, record_id, case, phone_number, start_date, end_date) -> DataFrame:
    out = df if case is None else df.where(F.col(CASE) == case)
    if phone_number is not None:
        out = out.where((F.col(sides[0]) == phone_number) | (F.col(sides[1]) == phone_number))
    return _in_period(out, "timestamp", start_date, end_date).orderBy("timestamp", record_id)


def search_calls(calls: DataFrame, case=None, phone_number=None, start_date=None, end_date=None) -> DataFrame:
    return _search_contacts(calls, ("caller", "callee"), "call_id", case, phone_number, start_date, end_date)


def search_messages(messages: DataFrame, case=None, phone_number=None, start_date=None, end_date=None) -> DataFrame:
    return _search_contacts(messages, ("sender", "recipient"), "message_id", case, phone_number, start_date, end_date)


def case_list(cases: DataFrame, status=None, lead_investigator=None, start_date_from=None, start_date_to=None,
              skip: int = 0, limit: int | None = None) -> DataFrame:
    out = cases if status is None else cases.where(F.col("status") == status)
    if lead_investigator is not None:
        out = out.where(F.col("lead_investigator") == lead_investigator)
    out = _in_period(out, "start_date", start_date_from, start_date_to)
    return page(out.orderBy(F.desc("start_date"), CASE), limit, skip)


def file_list(files: DataFrame, case=None, source_type=None, processing_status=None, skip: int = 0,
              limit: int | None = None) -> DataFrame:
    out = files
    for column, value in ((CASE, case), ("source_type", source_type), ("processing_status", processing_status)):
        if value is not None:
            out = out.where(F.col(column) == value)
    return page(out.orderBy(F.desc("received_date"), "source_id"), limit, skip)


def pending_files(files: DataFrame) -> DataFrame:
    return files.where("processing_status = 'pending'").orderBy("received_date", "source_id")


def active_cases(cases: DataFrame) -> DataFrame:
    return cases.where("status = 'active'").select(CASE).distinct()


def summary_search(records: DataFrame, key: str, value: str) -> DataFrame:
    return records.where(F.get_json_object("summary", f"$.{key}") == value)


def keyword_search(df: DataFrame, query: str, record_id: str, text_col: str) -> DataFrame:
    """Rows that hold a word of the query, stop words aside, with the words found."""
    from pyspark.ml.feature import StopWordsRemover

    from ..functions.text import tokens

    stop = F.array(*[F.lit(w) for w in StopWordsRemover.loadDefaultStopWords("dutch")])
    wanted = F.array_except(tokens(F.lit(query)), F.array_union(stop, F.array(F.lit(""))))
    found = df.select(record_id, F.array_sort(F.array_intersect(tokens(F.col(text_col)), wanted)).alias("matched_terms"))
    return found.where(F.size("matched_terms") > 0)
