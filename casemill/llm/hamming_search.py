"""Exact top-k search in binary codes by incremental multi-index hashing.

A vector's code has one bit per component, set where the component is above 0, in words of 64 bits
(here: one). A code is cut into SEGMENTS segments of 16 bits, and rows are indexed by segment and
value. By the pigeonhole principle a code within Hamming distance r * SEGMENTS + SEGMENTS - 1 of the
query differs by r bits at most in some segment. So the search radius of the segments grows from 0:
each round looks up the values at exactly that radius, adds the codes found, and ends for a query when
k rows within the distance proven by the radius are known. Queries are all rows with vec_id divisible
by ``every``.

Rows of equal codes stand in the index as one code with its k least vec_ids, the only ones that can
enter an answer; they are picked by a limit per code and salt first, so a code that a third of all rows
share is split. Candidates are compared as codes; one farther than the k-th best known of its query is
dropped where it is found, and only what can still be among the k best goes from round to round. An index
of at most SMALL_INDEX entries is sent to the executors; beyond that lookups and index are shuffled.

Result: vec_id (of the query), rank from 1, neighbour, distance; the query itself is no neighbour; ties
go to the smaller vec_id. There are fewer than k rows where the table has fewer. Rows whose vector or
id is null, or whose length isn't ``bits``, are neither query nor neighbour; null and NaN components
give unset bits. Rows of one vec_id and code count once. Other columns are not read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window as W, functions as F

from ._shared import stored

K = 10
EVERY = 50
BITS = 64
WIDTH = 16
SALTS = 64
SMALL_INDEX = 1_000_000  # entries of the index that may be sent to all executors, 20 MB; a larger one is shuffled


def codes(vectors: DataFrame, bits: int = BITS) -> DataFrame:
    """(vec_id, code): the signs of the components as a long."""
    x = F.transform("embedding", lambda v, k: F.when((v > 0) & ~F.isnan(v), F.call_function("shiftleft", F.lit(1).cast("bigint"), k)).otherwise(F.lit(0).cast("bigint")))
    code = F.aggregate(x, F.lit(0).cast("bigint"), lambda a, b: a.bitwiseOR(b))
    return vectors.where(F.col("vec_id").isNotNull() & (F.size("embedding") == bits)).select(F.col("vec_id").cast("bigint").alias("vec_id"), code.alias("code"))


def masks(radius: int) -> Column:
    """The words of WIDTH bits of which ``radius`` are set: a constant, made once and not for each row."""
    return F.split(F.lit(",".join(str(m) for m in range(1 << WIDTH) if m.bit_count() == radius)), ",").cast("array<int>")


def top_k(vectors: DataFrame, k: int = K, every: int = EVERY) -> DataFrame:
    """(vec_id, rank, neighbour, distance) for all rows with vec_id divisible by ``every``."""
    spark, segments = vectors.sparkSession, BITS // WIDTH
    rows = stored(codes(vectors).distinct(), "codes")
    salted = rows.withColumn("salt", F.pmod(F.xxhash64("vec_id"), F.lit(SALTS))).withColumn("place", F.row_number().over(W.partitionBy("code", "salt").orderBy("vec_id"))).where(F.col("place") <= k + 1)
    first = salted.withColumn("place", F.row_number().over(W.partitionBy("code").orderBy("vec_id"))).where(F.col("place") <= k + 1).select("vec_id", "code")
    first = stored(first, "first-of-code")
    slot = lambda c: F.explode(F.array(*[F.shiftrightunsigned(c, s * WIDTH).bitwiseAND(F.lit((1 << WIDTH) - 1)).cast("int") + F.lit(s << WIDTH) for s in range(segments)]))
    index = stored(first.groupBy("code").agg(F.count("*").alias("ids")).select("code", "ids", slot(F.col("code")).alias("slot")), "segments")
    # the lookups far outnumber the index; without a hint their number is underestimated and they would be sent around
    index = F.broadcast(index) if index.count() <= SMALL_INDEX else index.hint("merge")
    tasks = int(spark.conf.get("spark.sql.shuffle.partitions"))
    queries = rows.where(F.col("vec_id") % every == 0)
    open_ = stored(queries.select(F.col("code").alias("query"), F.lit(BITS).alias("worst")).distinct(), "open")
    best = found = None
    for radius in range(WIDTH + 1):
        probes = open_.select("query", "worst", slot(F.col("query")).alias("slot")).repartition(tasks, "query", "slot").withColumn("mask", F.explode(masks(radius)))
        probes = probes.select("query", "worst", F.col("slot").bitwiseXOR(F.col("mask")).alias("slot"))
        distance = F.bit_count(F.col("query").bitwiseXOR(F.col("code"))).cast("int")
        hits = probes.join(index, "slot").where(distance <= F.col("worst")).select("query", "code", "ids", distance.alias("distance"))
        hits = hits if found is None else hits.union(found.join(open_, "query", "left_semi"))
        hits = stored(_needed(hits.distinct(), k), "found")
        proven = radius * segments + segments - 1
        ids = lambda within: F.coalesce(F.sum(F.when(within, F.col("ids"))), F.lit(0))
        state = hits.groupBy("query").agg((ids(F.col("distance") <= proven) > k).alias("done"), F.when(ids(F.lit(True)) > k, F.max("distance")).otherwise(BITS).alias("worst"))
        state = stored(state, "open")
        done = hits.join(state.where("done"), "query", "left_semi").select("query", "code", "distance")
        best = done if best is None else best.union(done)
        open_, found = state.where("NOT done").select("query", "worst"), hits
        if open_.isEmpty():
            break
    else:
        best = best.union(found.join(open_, "query", "left_semi").select("query", "code", "distance"))
    answers = queries.join(best.withColumnRenamed("code", "near"), F.col("code") == F.col("query")).join(first.select(F.col("vec_id").alias("neighbour"), F.col("code").alias("near")), "near").where(F.col("neighbour") != F.col("vec_id"))
    rank = F.row_number().over(W.partitionBy("vec_id").orderBy("distance", "neighbour"))
    return answers.withColumn("rank", rank.cast("bigint")).where(F.col("rank") <= k).select("vec_id", "rank", "neighbour", F.col("distance").cast("bigint").alias("distance"))


def _needed(hits: DataFrame, k: int) -> DataFrame:
    """Of each query's codes, in order of distance, those of distances at which fewer than k + 1 ids were known before."""
    near = hits.withColumn("upto", F.sum("ids").over(W.partitionBy("query").orderBy("distance").rangeBetween(W.unboundedPreceding, -1)))
    return near.where(F.coalesce("upto", F.lit(0)) <= k).select("query", "code", "ids", "distance")
