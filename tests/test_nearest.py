"""The nearest point by the tree of cells, against all distances, where points crowd."""

import math
import random

import pytest

from casemill.operators import nearest


def km(a, b):
    la, lb = math.radians(a[0]), math.radians(b[0])
    cosine = math.cos(la) * math.cos(lb) * math.cos(math.radians(b[1] - a[1])) + math.sin(la) * math.sin(lb)
    return 6371 * math.acos(max(-1.0, min(1.0, cosine)))


@pytest.mark.parametrize("crowd", [3, 64])
def test_crowded_cells(spark, crowd):
    rng = random.Random(11)
    near = lambda lat, lon, spread: (lat + rng.uniform(-spread, spread), lon + rng.uniform(-spread, spread))
    spots = [near(52.0, 4.0, 0.002) for _ in range(150)] + [near(52.0, 4.0, 0.5) for _ in range(60)] + [near(-10.0, 179.9, 0.05) for _ in range(20)] + [(89.9, k * 30.0) for k in range(5)]
    spots += [spots[0]] * 3
    points = [near(52.0, 4.0, 0.002) for _ in range(120)] + [near(52.0, 4.0, 1.0) for _ in range(60)] + [near(-10.0, -179.9, 0.1) for _ in range(20)] + [(0.0, 0.0), (-90.0, 5.0), (89.99, 50.0)]
    left = spark.createDataFrame([(k, *p) for k, p in enumerate(points)] + [(999, None, 1.0)], "k int, lat double, lon double")
    right = spark.createDataFrame([(f"s{k:03}", *p) for k, p in enumerate(spots)] + [("none", None, None)], "id string, lat double, lon double")
    got = {r.k: r for r in nearest.nearest(left, right, "id", ["k"], crowd=crowd).collect()}
    assert set(got) == set(range(len(points)))
    for k, p in enumerate(points):
        best = min(km(p, s) for s in spots)
        assert abs(got[k].distance_km - best) < 2e-4
    if crowd == 3:
        spots_only = right.where("lat IS NOT NULL").dropDuplicates(["lat", "lon"])
        assert len(nearest._levels(left.where("lat IS NOT NULL"), spots_only, nearest.GRIDS, crowd)) > 2


def test_no_points(spark):
    left = spark.createDataFrame([(1, 1.0, 1.0)], "k int, lat double, lon double")
    none = spark.createDataFrame([], "id string, lat double, lon double")
    assert nearest.nearest(left, none, "id", ["k"]).count() == 0
    assert nearest.nearest(left.limit(0), none, "id", ["k"]).count() == 0
