"""Micro-batch jobs. Each batch owns a folder it replaces as a whole, so a replay adds nothing twice."""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from ..operators.canonical import canonical_transactions, map_calls, map_messages, validate_communications
from ..operators.intake import detect_file_types
from ..operators.keyed import newest_per_key, upsert_partial
from ..plans.market import TRADE_COLUMNS, candle_parts, complete_trades, incomplete_trades, merge_parts, parse_trades

BATCH = "batch"


ROWS_PER_FILE = 1_000_000


def _dealt(df: DataFrame, parts: tuple[str, ...]) -> DataFrame:
    """Rows of one folder brought together, so that it gets one file for each ``ROWS_PER_FILE`` rows and not one per task."""
    files = df.groupBy(*parts).agg(F.ceil(F.count("*") / F.lit(ROWS_PER_FILE)).alias("_files"))
    files = F.broadcast(files.select(*[F.col(p).alias(f"_{p}") for p in parts], "_files"))
    same = F.lit(True)
    for p in parts:
        same = same & F.col(p).eqNullSafe(F.col(f"_{p}"))
    lot = F.pmod(F.xxhash64(*df.columns), F.col("_files"))
    return df.join(files, same).withColumn("_lot", lot).repartition(*parts, "_lot").select(*df.columns)


def write_batch(df: DataFrame, path: str, batch_id: int, parts: tuple[str, ...] = ()) -> None:
    """The folder of a batch, replaced as a whole; with ``parts`` one in each folder of their values."""
    if parts:
        df = df.persist()
        try:
            _write(_dealt(df, parts), path, batch_id, parts)
        finally:
            df.unpersist()
    else:
        _write(df, path, batch_id)


def _write(df: DataFrame, path: str, batch_id: int, parts: tuple[str, ...] = ()) -> None:
    (df.withColumn(BATCH, F.lit(batch_id)).write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
     .partitionBy(*parts, BATCH).parquet(path))


STATE = {"spark.sql.streaming.stateStore.providerClass": "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"}


def run(stream: DataFrame, sink: Callable[[DataFrame, int], None], checkpoint: str, state: bool = False) -> None:
    """Work off everything available now, then stop; the checkpoint remembers how far. ``state``: keyed state is kept in RocksDB."""
    conf = stream.sparkSession.conf
    before = {k: conf.get(k, None) for k in STATE} if state else {}
    for k in before:
        conf.set(k, STATE[k])
    try:
        query = (stream.writeStream.foreachBatch(sink).option("checkpointLocation", checkpoint)
                 .trigger(availableNow=True).start())
        query.awaitTermination()
    finally:
        for k, v in before.items():
            conf.unset(k) if v is None else conf.set(k, v)


def file_stream(spark: SparkSession, path: str, schema: str, form: str = "parquet", per_batch: int = 1000) -> DataFrame:
    return (spark.readStream.format(form).schema(schema).option("maxFilesPerTrigger", per_batch)
            .option("recursiveFileLookup", True).load(path))


TRADE_ID = ["symbol", "trade_id"]
TRADE_TABLE = ", ".join(f"{c} {t}" for c, t in TRADE_COLUMNS.items()) + f", event_date string, {BATCH} int"


def stream_trades_bronze(spark: SparkSession, source: str, sink: str, checkpoint: str, per_batch: int = 1000, rejects: str | None = None, within: str | None = None) -> None:
    """JSON trade events to the trade table; a trade delivered again is dropped, whatever its time says then.

    The ids seen are keyed state in RocksDB, dealt over the shuffle partitions, so no stored trade is read again. They
    are kept for good; ``within`` (such as ``7 days``) bounds the state, and then a trade delivered again with an event
    time that lies further behind the newest one is late and dropped, too. Of several deliveries in one batch any one
    is kept; a batch that runs again replaces its folders.
    Messages that give no whole trade go to the table ``rejects`` (default: ``sink`` with ``_rejects``
    behind it), with the message as it came and the names of the fields that are missing.
    """
    spark.createDataFrame([], TRADE_TABLE).write.mode("append").partitionBy("event_date", BATCH).parquet(sink)
    messages = file_stream(spark, source, "value string", "text", per_batch)
    set_aside = rejects or f"{sink.rstrip('/')}_rejects"
    run(incomplete_trades(parse_trades(messages, keep=["value"]), keep=["value"]), lambda df, batch_id: write_batch(df, set_aside, batch_id), f"{checkpoint}/rejects")
    trades = complete_trades(parse_trades(messages))
    if within is None:
        once = trades.dropDuplicates(TRADE_ID)
    else:
        once = trades.withColumn("_at", F.col("event_time").cast("timestamp")).withWatermark("_at", within).dropDuplicatesWithinWatermark(TRADE_ID).drop("_at")

    def store(fresh: DataFrame, batch_id: int) -> None:
        dated = fresh.select(*TRADE_COLUMNS, F.date_format("event_time", "yyyy-MM-dd").alias("event_date"))
        write_batch(dated, sink, batch_id, ("event_date",))

    run(once, store, f"{checkpoint}/trades", state=True)


def _first_version(spark: SparkSession, sink: str, checkpoint: str) -> int:
    """Versions that a checkpoint writes begin here: behind all that other checkpoints have written to the sink."""
    note = f"{checkpoint}/first-version"
    try:
        return spark.read.schema("first bigint").parquet(note).first()["first"]
    except AnalysisException:
        pass
    try:
        newest = spark.read.parquet(sink).agg(F.max(F.col(BATCH).cast("bigint"))).first()[0]
    except AnalysisException:
        newest = None
    first = 0 if newest is None else newest + 1
    spark.range(1).select(F.lit(first).cast("bigint").alias("first")).write.mode("overwrite").parquet(note)
    return first


def stream_candles(spark: SparkSession, bronze: str, sink: str, checkpoint: str, per_batch: int = 1000) -> None:
    """Candles of all stored trades, each trade counted once however often its batch comes.

    A batch only names the minutes it touches. Their candles are made anew from the stored trades of their days
    and written as a version; ``read_candles`` takes the newest version of each minute. So a batch that is replayed,
    a trade table written again and a lost checkpoint all give the same candles, and late trades need no state.
    """
    first = _first_version(spark, sink, checkpoint)
    minute = F.date_trunc("minute", "event_time")

    def store(trades: DataFrame, batch_id: int) -> None:
        touched = trades.select("symbol", minute.alias("minute"), F.date_format("event_time", "yyyy-MM-dd").alias("event_date")).distinct()
        days = [r["event_date"] for r in touched.select("event_date").distinct().collect()]
        if not days:
            return
        known = spark.read.schema(TRADE_TABLE).parquet(bronze).where(F.col("event_date").isin(days))
        own = known.withColumn("minute", minute).join(touched, ["symbol", "minute", "event_date"], "left_semi")
        once = newest_per_key(own.select(*TRADE_COLUMNS), TRADE_ID, ["event_time", "ingested_at"])
        write_batch(candle_parts(once), sink, first + batch_id)

    schema = ", ".join(f"{c} {t}" for c, t in TRADE_COLUMNS.items())
    run(file_stream(spark, bronze, schema, per_batch=per_batch), store, checkpoint)


def read_candles(spark: SparkSession, sink: str) -> DataFrame:
    versions = spark.read.parquet(sink).withColumn(BATCH, F.col(BATCH).cast("bigint"))
    return merge_parts(newest_per_key(versions, ["symbol", "minute"], [BATCH]).drop(BATCH))


def stream_file_intake(spark: SparkSession, folder: str, sink: str, checkpoint: str, per_batch: int = 1000) -> None:
    """New files of a folder with their detected type."""
    files = (spark.readStream.format("binaryFile").option("recursiveFileLookup", True)
             .option("maxFilesPerTrigger", per_batch).load(folder))
    heads = files.select(F.element_at(F.split("path", "/"), -1).alias("file_name"),
                         F.decode("content", "UTF-8").alias("head"), F.col("length").alias("size"))
    run(heads, lambda df, batch_id: write_batch(detect_file_types(df).drop("head"), sink, batch_id), checkpoint)


def stream_upsert(spark: SparkSession, source: str, schema: str, sink: str, checkpoint: str, keys: list[str],
                  order: list[str], per_batch: int = 1000) -> None:
    """The newest row per key of each batch; ``read_upserted`` gives the newest of all."""
    run(file_stream(spark, source, schema, per_batch=per_batch),
        lambda df, batch_id: write_batch(newest_per_key(df, keys, order), sink, batch_id), checkpoint)


def read_upserted(spark: SparkSession, sink: str, keys: list[str], order: list[str]) -> DataFrame:
    return newest_per_key(spark.read.parquet(sink), keys, [*order, BATCH]).drop(BATCH)


# Raw rows of each kind as intake lands them.
RAW = {
    "transaction": "transaction_id string, investigation_id string, source_id string, iban_from string, iban_to string, bedrag decimal(15,2), datum date, omschrijving string, raw_data string",
    "call": "call_id string, investigation_id string, source_id string, caller_number string, called_number string, call_date string, call_time string, duration_seconds string, call_type string, raw_data string",
    "message": "message_id string, investigation_id string, source_id string, sender_number string, recipient_number string, message_text string, message_type string, raw_data string",
}
LANDED = "kind string, " + ", ".join(f"{kind} struct<{columns.replace(' ', ': ').replace(',: ', ', ')}>" for kind, columns in RAW.items())


def land_raw(raw: DataFrame, kind: str, folder: str) -> None:
    """Raw rows of one kind appended to the folder that ``stream_canonical`` watches."""
    own = T.StructType.fromDDL(RAW[kind])
    row = F.struct(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in own.fields])
    absent = {k: F.lit(None).cast(T.StructType.fromDDL(columns)) for k, columns in RAW.items()}
    raw.select(F.lit(kind).alias("kind"), *[c.alias(k) for k, c in (absent | {kind: row}).items()]).write.mode("append").parquet(folder)


def stream_canonical(spark: SparkSession, source: str, sink: str, checkpoint: str, as_of: dt.datetime, per_batch: int = 1000) -> None:
    """Raw rows of all kinds mapped and validated as they arrive: one stream, one checkpoint, a table for each kind below ``sink``.

    A batch is kept while its kinds are written, so the files are read once. Each kind's part of a batch replaces
    itself, so a batch that runs again after some of its kinds were written adds nothing twice. A raw row that comes again
    is a newer version of its record: ``read_canonical`` gives the first mapping with the status of the last.
    A kind of which no row has come yet has no table.
    """
    mapped = {
        "transaction": lambda raw: canonical_transactions(raw, as_of),
        "call": lambda raw: validate_communications(map_calls(raw)),
        "message": lambda raw: validate_communications(map_messages(raw)),
    }

    def store(landed: DataFrame, batch_id: int) -> None:
        landed = landed.persist()
        for kind, canonical in mapped.items():
            write_batch(canonical(landed.where(F.col("kind") == kind).select(f"{kind}.*")), f"{sink}/{kind}", batch_id)
        landed.unpersist()

    run(file_stream(spark, source, LANDED, per_batch=per_batch), store, checkpoint)


def read_canonical(spark: SparkSession, sink: str, kind: str) -> DataFrame:
    """One row per source record: the first mapping, with the status of the last."""
    mapped = spark.read.parquet(f"{sink}/{kind}").withColumn(BATCH, F.col(BATCH).cast("int"))
    keys = ["source_system_id", "source_record_id"]
    status = ["validation_status", "validation_errors", "validation_warnings", "data_completeness_score"]
    update = [c for c in status if c in mapped.columns]
    return upsert_partial(mapped.where(F.lit(False)), mapped, keys, update, [BATCH]).drop(BATCH)
