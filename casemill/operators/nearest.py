"""Nearest point of a second table, exact, without comparing every pair.

Both tables are laid on nested grids. From the coarsest grid down, a cell of the
left table keeps only those cells of the right table that can still hold the
nearest point: the closest a cell can be must not exceed the farthest the best
cell can be. Only the points in the surviving cells are compared.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window, functions as F

from ..functions.geo import EARTH_RADIUS_KM, distance_km
from ..session import scratch

GRIDS = (16.0, 2.0, 0.25, 0.03125)  # degrees, each a whole multiple of the next
KM_PER_DEGREE = 2 * 3.141592653589793 * EARTH_RADIUS_KM / 360
CROWD = 64  # points of a right cell that are compared whole
SPLIT = 8
FINEST = 1e-4  # degrees, about the slack
SLACK_KM = 0.01  # rounding of the arc cosine near zero


def _cell(lat: Column, lon: Column, size: float) -> list[Column]:
    return [F.floor((lat + 90) / size).cast("int"), F.floor((lon + 180) / size).cast("int")]


def _reach(size: float) -> float:
    """No point of a cell is farther than this from the middle of the cell, in km."""
    return size / 2 ** 0.5 * KM_PER_DEGREE + SLACK_KM


def _between_cells(size: float) -> Column:
    mid = lambda name, off: F.col(name) * size + size / 2 - off
    return distance_km(mid("ly", 90), mid("lx", 180), mid("ry", 90), mid("rx", 180))


def _cells(points: DataFrame, size: float, names: Sequence[str]) -> DataFrame:
    y, x = _cell(F.col("lat"), F.col("lon"), size)
    return points.select(y.alias(names[0]), x.alias(names[1])).distinct()


def _survivors(pairs: DataFrame, size: float) -> DataFrame:
    """Right cells that may hold the nearest point of some point in the left cell."""
    far = 2 * _reach(size)
    best = F.min("_mid").over(Window.partitionBy("ly", "lx"))
    return (pairs.withColumn("_mid", _between_cells(size)).withColumn("_best", best)
            .where(F.col("_mid") - far <= F.col("_best") + far).select("ly", "lx", "ry", "rx"))


def _split(kept: DataFrame, left: DataFrame, right: DataFrame, size: float, finer: float) -> DataFrame:
    """The pairs of cells of the next grid that pairs of this one lead to, pruned."""
    step = round(size / finer)
    up = lambda name: F.floor(F.col(name) / step).cast("int")
    inner_left = _cells(left, finer, ("cy", "cx")).withColumns({"ly": up("cy"), "lx": up("cx")})
    inner_right = _cells(right, finer, ("dy", "dx")).withColumns({"ry": up("dy"), "rx": up("dx")})
    pairs = (kept.join(inner_left, ["ly", "lx"]).join(inner_right, ["ry", "rx"])
             .select(F.col("cy").alias("ly"), F.col("cx").alias("lx"),
                     F.col("dy").alias("ry"), F.col("dx").alias("rx")))
    return _survivors(pairs, finer)


def cell_candidates(left: DataFrame, right: DataFrame, grids: Sequence[float] = GRIDS) -> DataFrame:
    """Left cell, right cell pairs of the finest grid; both inputs have ``lat, lon``."""
    size = grids[0]
    rows, cols = int(180 // size) + 1, int(360 // size) + 1
    world = F.explode(F.sequence(F.lit(0), F.lit(rows * cols - 1)))
    pairs = (_cells(left, size, ("ly", "lx")).withColumn("_c", world)
             .select("ly", "lx", F.floor(F.col("_c") / cols).cast("int").alias("ry"),
                     (F.col("_c") % cols).alias("rx"))
             .join(_cells(right, size, ("ry", "rx")), ["ry", "rx"]))
    kept = _survivors(pairs, size)
    for finer in grids[1:]:
        size, kept = finer, _split(kept, left, right, size, finer)
    return kept


def _levels(left: DataFrame, right: DataFrame, grids: Sequence[float], crowd: int) -> list[tuple[float, DataFrame]]:
    """(size, pairs of cells) of each level of the tree at which pairs of cells are compared point by point."""
    spark, size, out = left.sparkSession, grids[-1], []
    kept = cell_candidates(left, right, grids)
    while True:
        y, x = _cell(F.col("lat"), F.col("lon"), size)
        crowded = right.groupBy(y.alias("ry"), x.alias("rx")).agg(F.count("*").alias("n")).where(F.col("n") > crowd)
        if size <= FINEST or crowded.isEmpty():
            return [*out, (size, kept)]
        path = scratch(spark, "cells")  # each level is planned once
        kept.write.parquet(path)
        kept = spark.read.schema(kept.schema).parquet(path)
        out.append((size, kept.join(crowded, ["ry", "rx"], "left_anti").select("ly", "lx", "ry", "rx")))
        kept = kept.join(crowded, ["ry", "rx"], "left_semi").select("ly", "lx", "ry", "rx")
        size, kept = size / SPLIT, _split(kept, left, right, size, size / SPLIT)


def _paired(left: DataFrame, spots: DataFrame, right_id: str, kept: DataFrame, size: float) -> DataFrame:
    """Each row of ``left`` with the right points of its cell's pairs that can still be the nearest."""
    y, x = _cell(F.col("lat"), F.col("lon"), size)
    placed = spots.select(F.col("lat").alias("r_lat"), F.col("lon").alias("r_lon"), right_id,
                          y.alias("ry"), x.alias("rx"))
    middle = distance_km(F.col("ly") * size + size / 2 - 90, F.col("lx") * size + size / 2 - 180,
                         F.col("r_lat"), F.col("r_lon"))
    best = F.min("_mid").over(Window.partitionBy("ly", "lx"))
    options = (kept.join(placed, ["ry", "rx"]).withColumn("_mid", middle).withColumn("_best", best)
               .where(F.col("_mid") <= F.col("_best") + 2 * _reach(size)).select("ly", "lx", "r_lat", "r_lon", right_id))
    return left.withColumns({"ly": y, "lx": x}).join(options, ["ly", "lx"]).drop("ly", "lx")


def nearest(left: DataFrame, right: DataFrame, right_id: str, keys: Sequence[str],
            grids: Sequence[float] = GRIDS, crowd: int = CROWD) -> DataFrame:
    """One row per key of ``left``: the closest right point, ties by its id.

    ``left`` has ``lat, lon`` and any other columns; when several rows share the
    key the one with the smallest distance stays. ``right`` has ``lat, lon`` and
    ``right_id``. Rows without a position have no nearest point and drop out.
    Adds ``right_id`` and ``distance_km`` (rounded to a millimetre).
    """
    left = left.where("lat IS NOT NULL AND lon IS NOT NULL")
    spots = (right.where("lat IS NOT NULL AND lon IS NOT NULL")
             .groupBy("lat", "lon").agg(F.min(right_id).alias(right_id)))
    parts = [_paired(left, spots, right_id, kept, size) for size, kept in _levels(left, spots, grids, crowd)]
    paired = reduce(DataFrame.unionByName, parts)
    far = F.round(distance_km(F.col("lat"), F.col("lon"), F.col("r_lat"), F.col("r_lon")), 6)
    rest = [c for c in left.columns if c not in keys]
    pick = F.min(F.struct(far.alias("distance_km"), F.col(right_id), *rest)).alias("_pick")
    return paired.groupBy(*keys).agg(pick).select(
        *keys, *[F.col(f"_pick.{c}").alias(c) for c in [*rest, right_id, "distance_km"]])
