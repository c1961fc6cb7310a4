"""Spans of rings against cells counted one by one."""

from __future__ import annotations

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from terrasheaf.operators import grid as R
from terrasheaf.operators import spans as S
from terrasheaf.operators import spatial as P
from terrasheaf.operators import zonal as Z

GRID = "tile string, x0 double, y0 double, dx double, dy double, ncols int, nrows int, crs string, nodata long"
RING = "tile string, id string, ring array<struct<x double, y double>>"
PIXELS = "tile string, row int, col int, value double"


def made(seed, n_rings=14, n_pixels=4000, odd=False):
    """Triangles and boxes over 130 rows of 2,100 columns, in two tiles with rising and falling rows; some pixels twice, null or not finite."""
    rng = np.random.default_rng(seed)
    grids = [("a", 0.0, 0.0, 1.0, 1.0, 2100, 130, "c", 0), ("b", 500.0, 900.0, 2.0, -3.0, 2100, 130, "c", 0)]
    rings = []
    for k in range(n_rings):
        tile, x0, y0, dx, dy, *_ = grids[k % 2]
        x, y, w, h = rng.uniform(-50, 2100), rng.uniform(-9, 130), rng.uniform(1, 1700), rng.uniform(1, 70)
        points = [(x, y), (x + w, y), (x + w, y + h), (x, y + h)] if k % 3 else [(x, y), (x + w, y + h / 2), (x + w / 3, y + h)]
        points = [(x0 + dx * p, y0 + dy * q) for p, q in points]
        rings.append((tile, f"r{k // 2 % 5}", [*points, points[0]]))
    value = lambda: rng.choice([None, math.inf, -math.inf, math.nan]) if odd and rng.random() < 0.004 else None if rng.random() < 0.1 else float(rng.integers(-9, 99))
    pixels = [(str(rng.choice(["a", "b"])), int(rng.integers(0, 130)), int(rng.integers(0, 2100)), value()) for _ in range(n_pixels)]
    return grids, rings, pixels + pixels[:50]


def inside(ring, x, y):
    hit = False
    for (x1, y1), (x2, y2) in zip(ring, ring[1:]):
        if (y1 > y) != (y2 > y) and x < (x2 - x1) * (y - y1) / (y2 - y1) + x1:
            hit = not hit
    return hit


def cells(grids, rings, pixels):
    place = {g[0]: g for g in grids}
    for tile, key, ring in rings:
        _, x0, y0, dx, dy, *_ = place[tile]
        for t, r, c, v in pixels:
            if t == tile and inside(ring, x0 + (c + 0.5) * dx, y0 + (r + 0.5) * dy):
                yield tile, key, r, c, v


@pytest.mark.parametrize("odd", [False, True])
def test_zonal_statistics_by_cell(spark, odd):
    grids, rings, pixels = made(1, odd=odd)
    frames = spark.createDataFrame(rings, RING), spark.createDataFrame(grids, GRID), spark.createDataFrame(pixels, PIXELS)
    want = {}
    for tile, key, _, _, v in cells(grids, rings, pixels):
        want.setdefault((tile, key), []).append(v)
    got = {(r["tile"], r["id"]): r for r in Z.zonal_stats(*frames, ["tile", "id"], ("mean", "max")).collect()}
    assert set(got) == set(want)
    for k, values in want.items():
        known = np.array([v for v in values if v is not None])
        with np.errstate(invalid="ignore"):
            mean, top = known.mean(), known.max()
        assert got[k]["pixel_count"] == len(values)
        assert got[k]["mean"] == pytest.approx(mean, abs=1e-6, nan_ok=True) and (got[k]["max"] == top or math.isnan(top) and math.isnan(got[k]["max"]))


@pytest.mark.parametrize("most", [10**9, 7])
def test_joined_cells_and_crowded_blocks(spark, monkeypatch, most):
    monkeypatch.setattr(S, "BLOCK_SPANS", most)
    grids, rings, pixels = made(2)
    frames = spark.createDataFrame(rings, RING), spark.createDataFrame(grids, GRID), spark.createDataFrame(pixels, PIXELS)
    order = lambda r: tuple(str(x) for x in r)
    got = [(r["tile"], r["id"], r["row"], r["col"], r["value"]) for r in R.zonal_join(*frames, ["id"]).collect()]
    assert sorted(got, key=order) == sorted(cells(grids, rings, pixels), key=order)
    assert R.zonal_join(*frames, ["id"]).schema["row"].dataType.simpleString() == "int"


@pytest.mark.parametrize("most", [10**9, 5])
def test_overlaid_areas_by_cell(spark, monkeypatch, most):
    monkeypatch.setattr(S, "BLOCK_SPANS", most)
    monkeypatch.setattr(S, "PAIRS", 10)
    grids, rings, _ = made(3)
    _, others, _ = made(4)
    a, b = spark.createDataFrame(rings, RING), spark.createDataFrame(others, RING).withColumnRenamed("id", "other")
    grid = spark.createDataFrame(grids, GRID)
    mine, theirs = R.rasterize(a, grid, ["id"]), R.rasterize(b, grid, ["other"])
    areas = F.when(F.col("tile") == "a", 1.0).otherwise(6.0)
    want = mine.join(theirs, ["tile", "row", "col"]).groupBy("tile", "id", "other").count().join(mine.groupBy("tile", "id").agg(F.count(F.lit(1)).alias("n")), ["tile", "id"])
    want = want.select("tile", "id", "other", (F.col("count") * areas).alias("area"), (100.0 * F.col("count") / F.col("n")).alias("pct"))
    got = P.overlay_area(a, b, grid, "id", "other")
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, want.collect()))


def exchanged(df):
    """The columns of each exchange of a plan that isn't a broadcast."""
    plan = df._jdf.queryExecution().executedPlan().toString()
    return [line for line in plan.split("\n") if "Exchange hashpartitioning" in line]


def test_no_cell_is_shuffled(spark):
    grids, rings, pixels = made(5)
    frames = spark.createDataFrame(rings, RING), spark.createDataFrame(grids, GRID), spark.createDataFrame(pixels, PIXELS)
    for df in (Z.zonal_stats(*frames, ["tile", "id"]), P.overlay_area(frames[0], frames[0].withColumnRenamed("id", "other"), frames[1], "id", "other")):
        assert exchanged(df) and not any(", col#" in line for line in exchanged(df))


def test_empty_sides(spark):
    grids, rings, pixels = made(6, 4, 100)
    frames = spark.createDataFrame(rings, RING), spark.createDataFrame(grids, GRID), spark.createDataFrame(pixels, PIXELS)
    assert Z.zonal_stats(frames[0].limit(0), frames[1], frames[2], ["tile", "id"]).collect() == []
    assert Z.zonal_stats(frames[0], frames[1], frames[2].limit(0), ["tile", "id"]).collect() == []
    assert P.overlay_area(frames[0], frames[0].limit(0).withColumnRenamed("id", "other"), frames[1], "id", "other").collect() == []


def test_all_levels_of_a_pyramid_from_one_order(spark):
    rng = np.random.default_rng(7)
    rows = [(float(a), float(b), None if k % 9 == 0 else 1.0) for k, (a, b) in enumerate(np.concatenate([rng.uniform((-180, -80), (180, 80), (300, 2)), rng.uniform((-98, 40), (-97, 41), (600, 2)), [[-97.5, 40.5]] * 50]))]
    points = spark.createDataFrame(rows, "lon double, lat double, value double").repartition(6)
    got = sorted(map(tuple, R.xyz_pyramid(points, 3, 9).collect()))
    want = {}
    for z in range(3, 10):
        x, y = R.G.xyz_tile(F.col("lon"), F.col("lat"), F.lit(9))
        for r in points.where("value IS NOT NULL").select(x.alias("x"), y.alias("y")).collect():
            k = (z, r["x"] >> 9 - z, r["y"] >> 9 - z)
            want[k] = want.get(k, 0) + 1
    assert got == sorted((*k, n) for k, n in want.items())
    assert R.xyz_pyramid(points.limit(0), 3, 9).collect() == []
