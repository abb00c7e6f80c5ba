"""Per-key picks, upserts, numbering and look-back that hold up when one key is huge."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F


def _pick(df: DataFrame, keys: Sequence[str], order: Sequence[str], newest: bool) -> DataFrame:
    """One row per key by the order columns, other columns breaking ties.

    A struct extreme combines on the map side, so a hot key reaches the shuffle
    as one row per task. Nulls compare lowest: they lose against any value when
    the newest row is asked for.
    """
    rest = [c for c in df.columns if c not in keys and c not in order]
    packed = F.struct(*order, *rest)
    extreme = F.max(packed) if newest else F.min(packed)
    best = df.groupBy(*keys).agg(extreme.alias("_best"))
    return best.select(*[F.col(c) if c in keys else F.col(f"_best.{c}").alias(c) for c in df.columns])


def newest_per_key(df: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    return _pick(df, keys, order, True)


def first_per_key(df: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    return _pick(df, keys, order, False)


def upsert_latest(old: DataFrame, new: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """Full replace by key: new rows win over old ones, the latest new row over earlier new ones."""
    tagged = old.withColumn("_new", F.lit(0)).unionByName(new.select(*old.columns).withColumn("_new", F.lit(1)))
    return newest_per_key(tagged, keys, ["_new", *order]).drop("_new")


def upsert_partial(old: DataFrame, new: DataFrame, keys: Sequence[str], update: Sequence[str],
                   order: Sequence[str]) -> DataFrame:
    """Insert unknown keys; of known keys overwrite only the ``update`` columns.

    Several new rows of one key act in order: the first inserts, the last updates.
    """
    cols = [c for c in old.columns if c not in keys]
    step = F.struct(F.lit(0).alias("_new"), *order, *[c for c in cols if c not in order])
    later = F.struct(F.lit(1).alias("_new"), *order, *[c for c in cols if c not in order])
    marked = old.select(*keys, step.alias("_step")).unionByName(new.select(*old.columns).select(*keys, later.alias("_step")))
    ends = marked.groupBy(*keys).agg(F.min("_step").alias("_kept"), F.max("_step").alias("_last"))
    return ends.select(*[
        F.col(c) if c in keys else F.col(f"{'_last' if c in update else '_kept'}.{c}").alias(c)
        for c in old.columns])


def insert_absent(old: DataFrame, new: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """Keep every old row; add the first new row of each key not there yet."""
    added = first_per_key(new.select(*old.columns), keys, order).join(old.select(*keys), list(keys), "left_anti")
    return old.unionByName(added)


def spread_join(left: DataFrame, right: DataFrame, keys: Sequence[str], how: str = "left") -> DataFrame:
    """Equi join for keys of any frequency.

    Adaptive execution splits the partitions of frequent keys while it runs, so the plan holds either
    side once. Left rows without a key, which match nothing but would all land in one partition, are
    dealt out by a hash of the row instead.
    """
    keys = list(keys)
    known = F.lit(True)
    for key in keys:
        known = known & F.col(key).isNotNull()
    if how in ("inner", "left_semi"):
        return left.where(known).join(right, keys, how)
    others = [c for c in left.columns if c not in keys]
    lot = F.when(~known, F.xxhash64(*(others or keys)))
    return _spread(left.withColumn("_lot", lot), right, keys, how)


def _spread(left: DataFrame, right: DataFrame, keys: list[str], how: str) -> DataFrame:
    lot = F.coalesce("_lot", F.lit(0))
    r = right.select(*[F.col(k).alias(f"_r_{k}") for k in keys], *[c for c in right.columns if c not in keys], F.lit(0).cast("bigint").alias("_r_lot"))
    on = lot == F.col("_r_lot")
    for k in keys:
        on = on & (F.col(k) == F.col(f"_r_{k}"))
    out = left.join(r, on, how)
    rest = [c for c in left.columns if c not in (*keys, "_lot")]
    return out.select(*keys, *rest, *[c for c in right.columns if c not in keys])


def previous_value(df: DataFrame, key: str, at: str, value: str, out: str, bucket: str = "day") -> DataFrame:
    """The value of the row before, per key in order of ``at``.

    A key is cut into time buckets, each ordered on its own; the first row of a
    bucket takes the last value of the bucket before it from a small summary.
    """
    cut = df.withColumn("_bucket", F.date_trunc(bucket, at))
    inside = Window.partitionBy(key, "_bucket").orderBy(at)
    across = Window.partitionBy(key).orderBy("_bucket")
    carried = (cut.groupBy(key, "_bucket").agg(F.max_by(value, at).alias("_last"))
               .withColumn("_carry", F.lag("_last").over(across)).drop("_last"))
    return (cut.withColumn("_rank", F.row_number().over(inside))
            .withColumn("_prev", F.lag(value).over(inside))
            .join(carried, [key, "_bucket"], "left")
            .withColumn(out, F.when(F.col("_rank") == 1, F.col("_carry")).otherwise(F.col("_prev")))
            .drop("_bucket", "_rank", "_prev", "_carry"))


def last_known(df: DataFrame, key: str, order: Sequence[str], value: str, out: str, bucket: Column) -> DataFrame:
    """The last non-null value on the rows before, per key; cut into buckets as above."""
    cut = df.withColumn("_bucket", bucket)
    earlier = Window.unboundedPreceding, -1
    inside = Window.partitionBy(key, "_bucket").orderBy(*order).rowsBetween(*earlier)
    across = Window.partitionBy(key).orderBy("_bucket").rowsBetween(*earlier)
    newest = F.max(F.when(F.col(value).isNotNull(), F.struct(*order, value)))
    carried = (cut.groupBy(key, "_bucket").agg(newest.alias("_end"))
               .withColumn("_carry", F.last(f"_end.{value}", ignorenulls=True).over(across)).drop("_end"))
    return (cut.withColumn("_seen", F.last(value, ignorenulls=True).over(inside))
            .join(carried, [key, "_bucket"], "left")
            .withColumn(out, F.coalesce("_seen", "_carry")).drop("_bucket", "_seen", "_carry"))


def number_rows(df: DataFrame, group: Sequence[str], order: Sequence[str], bucket: Column,
                out: str = "number", start: DataFrame | None = None) -> DataFrame:
    """1, 2, 3 … per group in the given order, without one task sorting a whole group.

    ``bucket`` must not decrease along the order. Rows are numbered per bucket
    and shifted by the count of the earlier buckets. ``start`` (group columns, ``highest``): numbers go on from there;
    it meets the counts of the buckets alone, never the rows.
    """
    cut = df.withColumn("_bucket", bucket)
    inside = Window.partitionBy(*group, "_bucket").orderBy(*order)
    before = Window.partitionBy(*group).orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
    shift = (cut.groupBy(*group, "_bucket").agg(F.count("*").alias("_n"))
             .withColumn("_shift", F.coalesce(F.sum("_n").over(before), F.lit(0))).drop("_n"))
    if start is not None:
        shift = (shift.join(start.select(*group, "highest"), list(group), "left")
                 .withColumn("_shift", F.col("_shift") + F.coalesce("highest", F.lit(0))).drop("highest"))
    same = F.lit(True)
    numbered = cut.withColumn("_row", F.row_number().over(inside)).alias("l")
    shift = shift.hint("shuffle_hash").alias("r")  # the counts are held, the rows pass by
    for name in [*group, "_bucket"]:
        same = same & F.col(f"l.{name}").eqNullSafe(F.col(f"r.{name}"))
    return numbered.join(shift, same, "inner").select(
        *[F.col(f"l.{c}") for c in df.columns], (F.col("l._row") + F.col("r._shift")).cast("bigint").alias(out))


def new_ids(df: DataFrame, known: DataFrame, group: str, order: Sequence[str], bucket: Column) -> DataFrame:
    """Number new rows per group, on from the highest number known (``group, highest``)."""
    return number_rows(df, [group], order, bucket, start=known)


def change_log(old: DataFrame, new: DataFrame, keys: Sequence[str], buckets: int = 1 << 16) -> DataFrame:
    """Inserts, updates and deletes between two snapshots, rows kept as JSON.

    Rows are dealt into ``buckets`` by their keys, and each bucket is summed up as its row count and 128 bits of
    row fingerprints, before anything is shuffled. Only rows of buckets that differ are joined, so snapshots that
    agree nearly everywhere cost two scans; there are at most ``buckets`` rows to send around.
    """
    columns = old.columns
    whole = F.to_json(F.struct(*columns))
    bucket = F.pmod(F.xxhash64(*keys), F.lit(buckets)).alias("_bucket")

    def summed(df: DataFrame, side: str) -> DataFrame:
        prints = df.select(bucket, F.xxhash64(whole).alias("x"), F.xxhash64(F.lit(1), whole).cast("decimal(38,0)").alias("y"))
        return prints.groupBy("_bucket").agg(F.struct(F.count("*").alias("n"), F.bit_xor("x").alias("x"), F.sum("y").alias("y")).alias(side))

    new = new.select(*columns)
    differ = summed(old, "old").join(summed(new, "new"), "_bucket", "full_outer").where(~F.equal_null("old", "new")).select("_bucket")
    differ = F.broadcast(differ)
    rows = lambda df, name: df.select(*keys, whole.alias(name), bucket).join(differ, "_bucket", "left_semi").drop("_bucket")
    sides = rows(old, "old_json").join(rows(new, "new_json"), list(keys), "full_outer")
    op = (F.when(F.col("old_json").isNull(), "INSERT").when(F.col("new_json").isNull(), "DELETE")
          .when(F.col("old_json") != F.col("new_json"), "UPDATE"))
    return sides.withColumn("op", op).where("op IS NOT NULL").select("op", *keys, "old_json", "new_json")
