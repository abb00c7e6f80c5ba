"""Mixing sources to target weights by capped water-filling. DataFrame functions only.

Every source has a weight and a size in words. The mix holds as many words as all sources together;
a source's target is its share by weight, clamped at ``epochs`` times its size, and what is clamped off
goes to the other sources in proportion to their weights until no target is above its clamp. In the
order of clamp / weight the clamped sources come first, so one running sum over the sources finds them.

A document is taken floor(target / size) times whole, and once more if it comes early enough in a
seeded order of its source's documents: the order is a hash of seed, doc_id and text, and the limit is
the value up to which the words come nearest to what the whole repetitions leave open. The limit is
found from sums over 4096 hash buckets per source and then inside one bucket, so no task sees a
whole source. The shares are sent to the rows if they are few, else the rows of a source are salted. A rerun gives the same mix.

A null text has size 0; a null source is a source of its own, the last one. Rows that repeat doc_id,
source and text stand at one place of the order and are taken alike. A source without words gets the
target 0. An empty table gives an empty result. Other columns stay as they are.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window as W, functions as F

from ._shared import stored

EPOCHS = 3
SEED = 20240601
WORD = r"[^\x20\x09-\x0D]+"
BUCKET_BITS = 12
SMALL_SOURCES = 100_000  # sources of at most SMALL_BYTES of names in all are sent to all tasks
SMALL_BYTES = 8 << 20
SALTS = 64


def n_words(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("bigint")


def place(seed: int) -> Column:
    """The place of a row in its source's seeded order."""
    return F.xxhash64(F.lit(seed), "doc_id", "text")


def targets(sources: DataFrame, epochs: int = EPOCHS) -> DataFrame:
    """Add ``target`` to (source, source_size, weight)."""
    whole = W.partitionBy()
    before = whole.orderBy("ratio", F.col("source").isNull(), "source").rowsBetween(W.unboundedPreceding, -1)
    cap, sum0 = F.col("cap"), lambda c, w: F.coalesce(F.sum(c).over(w), F.lit(0.0))
    df = sources.withColumn("cap", F.lit(float(epochs)) * F.col("source_size")).withColumn("ratio", cap / F.col("weight"))
    df = df.withColumns({"total": F.sum("source_size").over(whole).cast("double"), "weights": F.sum("weight").over(whole).cast("double"), "cap_before": sum0("cap", before), "weight_before": sum0("weight", before)})
    df = df.withColumn("clamped", F.col("ratio") * (F.col("weights") - F.col("weight_before")) <= F.col("total") - F.col("cap_before"))
    free = F.col("total") - F.sum(F.when(F.col("clamped"), cap).otherwise(0.0)).over(whole)
    left = F.sum(F.when(F.col("clamped"), 0.0).otherwise(F.col("weight").cast("double"))).over(whole)
    return df.withColumn("level", F.try_divide(free, left)).select("source", "source_size", "weight", F.when(F.col("clamped"), cap).otherwise(F.coalesce(F.least(cap, F.col("level") * F.col("weight")), F.lit(0.0))).alias("target"))


def cycle(period: int = 3) -> Column:
    """Weights 1 to ``period`` by the source's place in code point order, null last, repeating."""
    return (F.row_number().over(W.partitionBy().orderBy(F.col("source").isNull(), "source")) - 1) % period + 1


def plan(sized: DataFrame, weight: Column, epochs: int = EPOCHS) -> DataFrame:
    """(source, source_size, target, whole, last): documents are taken ``whole`` times, up to place ``last`` once more.

    ``sized`` has source, size and place.
    """
    shift = 64 - BUCKET_BITS
    bucket = F.shiftright("place", shift)
    sums = sized.groupBy("source", bucket.alias("bucket")).agg(F.sum("size").alias("words"))
    sums = stored(sums, "mix-buckets")
    shares = targets(sums.groupBy("source").agg(F.sum("words").alias("source_size")).withColumn("weight", weight), epochs)
    shares = shares.withColumn("whole", F.coalesce(F.floor(F.try_divide("target", "source_size")), F.lit(0)))
    shares = stored(shares.withColumn("rest", F.col("target") - F.col("whole") * F.col("source_size")), "mix-shares")
    s, b = shares.alias("s"), sums.withColumn("upto", F.sum("words").over(W.partitionBy("source").orderBy("bucket"))).alias("b")
    cut = b.join(s, F.expr("b.source <=> s.source")).where("rest > 0 AND upto >= rest").groupBy("s.source").agg(F.min_by(F.struct("bucket", (F.col("upto") - F.col("words")).alias("before"), "rest"), "bucket").alias("c"))
    cut = stored(cut.select("source", "c.*"), "mix-cut")
    rows = sized.alias("d").join(cut.alias("c"), F.expr(f"d.source <=> c.source AND shiftright(d.place, {shift}) = c.bucket")).select("c.source", "c.bucket", "before", "rest", "place", "size")
    rows = rows.withColumn("upto", F.col("before") + F.sum("size").over(W.partitionBy("source").orderBy("place")))
    taken = rows.groupBy("source").agg(F.max(F.when(F.col("upto") - F.col("size") / 2 <= F.col("rest"), F.col("place"))).alias("last"))
    below = F.when(F.col("bucket") > -(1 << (BUCKET_BITS - 1)), F.shiftleft(F.col("bucket").cast("bigint"), shift) - 1)
    last = cut.alias("c").join(taken.alias("t"), F.expr("c.source <=> t.source"), "left").select("c.source", F.coalesce("last", below).alias("last"))
    return shares.alias("s").join(last.alias("l"), F.expr("s.source <=> l.source"), "left").select("s.source", "source_size", "target", "whole", "last")


def sized(docs: DataFrame, seed: int = SEED) -> DataFrame:
    """(doc_id, source, size, place) per row, stored."""
    return stored(docs.select("doc_id", "source", n_words(F.col("text")).alias("size"), place(seed).alias("place")), "mix-sized")


def mix(docs: DataFrame, weight: Column | None = None, epochs: int = EPOCHS, seed: int = SEED) -> DataFrame:
    """(doc_id, source, size, source_size, target, repeats, taken) per row of ``docs``.

    ``weight`` is an expression over one row per source (source, source_size); default: cycle().
    """
    rows = sized(docs, seed)
    shares = plan(rows, cycle() if weight is None else weight, epochs)
    return _with_repeats(rows, shares).select("doc_id", "source", "size", "source_size", "target", "repeats", (F.col("size") * F.col("repeats")).alias("taken"))


def _with_repeats(rows: DataFrame, shares: DataFrame) -> DataFrame:
    shares = shares.withColumnRenamed("source", "of")
    size = shares.agg(F.count("*").alias("n"), F.coalesce(F.sum(F.octet_length("of")), F.lit(0)).alias("bytes")).first()
    if size.n <= SMALL_SOURCES and size.bytes <= SMALL_BYTES:
        both = rows.join(F.broadcast(shares), F.expr("source <=> of"))
    else:  # rows of one source go to SALTS tasks
        spread = shares.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
        both = rows.withColumn("dealt", F.pmod("place", F.lit(SALTS)).cast("int")).join(spread, F.expr("source <=> of AND dealt = salt"))
    return both.withColumn("repeats", (F.col("whole") + F.when(F.col("place") <= F.col("last"), 1).otherwise(0)).cast("bigint"))


def repeated(docs: DataFrame, weight: Column | None = None, epochs: int = EPOCHS, seed: int = SEED) -> DataFrame:
    """The rows of ``docs``, each as often as the mix takes it."""
    shares = plan(sized(docs, seed), cycle() if weight is None else weight, epochs)
    row = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"), "source", place(seed).alias("place"))
    both = _with_repeats(row, shares).where("repeats > 0")
    return both.select("row", F.explode(F.sequence(F.lit(1), F.col("repeats").cast("int")))).select(*[F.col(f"row.`{c}`") for c in docs.columns])
