"""Pixel tables (tile, row, col, value), grids (one row a tile) and rings on them."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from terrasheaf.functions import geometry as G
from terrasheaf.operators.spans import span_cells
from terrasheaf.runtime import stored

CELL = ["tile", "row", "col"]


def valid_cells(pixels: DataFrame, grids: DataFrame) -> DataFrame:
    """Cells whose value is positive and not their grid's nodata."""
    return pixels.join(grids.select("tile", "nodata"), "tile").where((F.col("value") > 0) & ~F.col("value").eqNullSafe(F.col("nodata"))).drop("nodata")


def cell_centre(row: Column, col: Column) -> tuple[Column, Column]:
    """Coordinates of a cell's centre; the grid's columns x0, y0, dx, dy have to be there."""
    return F.col("x0") + (col + 0.5) * F.col("dx"), F.col("y0") + (row + 0.5) * F.col("dy")


def ring_spans(rings: DataFrame, grids: DataFrame, keep: list[str]) -> DataFrame:
    """(tile, row, low, high and ``keep``): the stretches of each row whose cells' centres lie in a ring.

    A ring is exploded to the rows of its bounding box, a row to the stretches between the ring's crossings with the row's centre line: no
    cell is tested one by one, and no ring meets cells far from it."""
    box = rings.join(grids, "tile").withColumn("box", G.ring_bbox(F.col("ring")))
    index = lambda v, zero, step, n: F.greatest(F.lit(0), F.least(n - 1, F.floor((v - zero) / step).cast("int")))
    r0, r1 = (index(F.col(f"box.{a}"), F.col("y0"), F.col("dy"), F.col("nrows")) for a in ("miny", "maxy"))
    rows = box.withColumn("row", F.explode(F.sequence(F.least(r0, r1), F.greatest(r0, r1))))
    rows = rows.withColumn("cross", G.crossings(F.col("ring"), F.col("y0") + (F.col("row") + 0.5) * F.col("dy")))
    place = lambda x: (x - F.col("x0")) / F.col("dx") - 0.5
    rising = F.col("dx") > 0

    def stretch(k: Column) -> Column:
        """The columns whose centre lies between crossings 2 k + 1 and 2 k + 2, the first included."""
        a, b = place(F.element_at("cross", 2 * k + 1)), place(F.element_at("cross", 2 * k + 2))
        low = F.when(rising, F.ceil(a)).otherwise(F.floor(b) + 1).cast("int")
        high = F.when(rising, F.ceil(b) - 1).otherwise(F.floor(a)).cast("int")
        return F.struct(F.greatest(F.lit(0), low).alias("low"), F.least(F.col("ncols") - 1, high).alias("high"))

    pairs = F.when(F.size("cross") >= 2, F.transform(F.sequence(F.lit(0), F.floor(F.size("cross") / 2).cast("int") - 1), stretch))
    spans = rows.withColumn("span", F.explode(pairs)).where("span.low <= span.high")
    return spans.select("tile", "row", F.col("span.low").alias("low"), F.col("span.high").alias("high"), *(k for k in keep if k != "tile"))


def rasterize(rings: DataFrame, grids: DataFrame, keep: list[str], overlay: str = "mask", order: str | None = None) -> DataFrame:
    """(tile, row, col and ``keep``): the cells whose centre lies in a ring, a row for each. In ``mask`` form a cell may belong to several rings;
    in ``burn`` form the ring that is last in ``order`` takes it."""
    hit = ring_spans(rings, grids, keep).withColumn("col", F.explode(F.sequence("low", "high")))
    if overlay == "mask":
        return hit.select(*CELL, *keep)
    top = hit.groupBy(*CELL).agg(F.max_by(F.struct(*keep), F.col(order)).alias("k"))
    return top.select(*CELL, "k.*")


def zonal_join(rings: DataFrame, grids: DataFrame, pixels: DataFrame, keep: list[str]) -> DataFrame:
    """(tile, row, col, ``keep``, value): each ring's cells with the pixels' values. Spans meet blocks of pixels, so cells without a pixel are
    never rows."""
    return span_cells(ring_spans(rings, grids, keep), pixels, keep)


def grid_check(a: DataFrame, b: DataFrame) -> DataFrame:
    """Per tile whether two grids have the same size, transform and CRS, and whether they overlap."""
    one, two = a.alias("a"), b.alias("b")
    same = F.lit(True)
    for c in ("x0", "y0", "dx", "dy", "ncols", "nrows", "crs"):
        same = same & F.col(f"a.{c}").eqNullSafe(F.col(f"b.{c}"))
    box = lambda t: G.grid_bbox(*(F.col(f"{t}.{c}") for c in ("x0", "y0", "dx", "dy", "ncols", "nrows")))
    p, q = box("a"), box("b")
    over = (p["minx"] < q["maxx"]) & (q["minx"] < p["maxx"]) & (p["miny"] < q["maxy"]) & (q["miny"] < p["maxy"])
    return one.join(two, "tile").select("tile", same.alias("aligned"), over.alias("overlapping"))


def require_aligned(a: DataFrame, b: DataFrame) -> None:
    bad = grid_check(a, b).where("NOT aligned").select("tile").take(1)
    if bad:
        raise ValueError(f"grids of tile {bad[0]['tile']} are not aligned")


def pixel_pair_join(fields: DataFrame, values: DataFrame, grid_a: DataFrame | None = None, grid_b: DataFrame | None = None) -> DataFrame:
    """(tile, row, col, field_id, value) of cells in both tables; unaligned grids are an error."""
    if grid_a is not None and grid_b is not None:
        require_aligned(grid_a, grid_b)
    return fields.withColumnRenamed("value", "field_id").join(values, CELL)


def align_to_grid(source: DataFrame, source_grids: DataFrame, target_grids: DataFrame, source_crs: int = 4326, target_crs: int = 4326) -> DataFrame:
    """The source's values on the cells of the target grid: for each target cell the source cell its centre falls in, null outside."""
    cells = target_grids.withColumn("row", F.explode(F.sequence(F.lit(0), F.col("nrows") - 1))).withColumn("col", F.explode(F.sequence(F.lit(0), F.col("ncols") - 1)))
    x, y = cell_centre(F.col("row"), F.col("col"))
    if source_crs != target_crs:
        x, y = G.reproject_xy(x, y, target_crs, source_crs)
    at = cells.select(*CELL, x.alias("cx"), y.alias("cy"))
    own = source_grids.select("tile", *(F.col(c).alias(f"s_{c}") for c in ("x0", "y0", "dx", "dy")))
    placed = at.join(own, "tile").select(*CELL, F.floor((F.col("cy") - F.col("s_y0")) / F.col("s_dy")).cast("int").alias("s_row"), F.floor((F.col("cx") - F.col("s_x0")) / F.col("s_dx")).cast("int").alias("s_col"))
    values = source.select("tile", F.col("row").alias("s_row"), F.col("col").alias("s_col"), "value")
    return placed.join(values, ["tile", "s_row", "s_col"], "left").select(*CELL, "value")


def key_allowlist(pixels: DataFrame, keys: DataFrame) -> DataFrame:
    """Cells whose value is among their tile's keys (tile, value)."""
    return pixels.join(keys, ["tile", "value"], "left_semi")


def field_cells(pixels: DataFrame) -> DataFrame:
    """Per tile and non-zero value: its cells and their extent."""
    return pixels.where("value <> 0").groupBy("tile", "value").agg(F.count(F.lit(1)).alias("cells"), *(f(c).alias(f"{n}_{c}") for c in ("row", "col") for n, f in (("min", F.min), ("max", F.max))))


def mosaic(pixels: DataFrame, order: str = "source_order") -> DataFrame:
    """Tiles on one shared grid; where they overlap the first source wins."""
    return pixels.where("value IS NOT NULL").groupBy("row", "col").agg(F.min_by("value", order).alias("value"))


#: Tiles whose counts a task holds before it sends them on.
HELD_TILES = 1_000_000


def counted_tiles(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """How often each key occurs, summed up before the shuffle."""
    keys, counts = np.zeros(0, np.int64), np.zeros(0, np.int64)
    for batch in batches:
        found, n = np.unique(batch.column(0).to_numpy(), return_counts=True)
        keys, at = np.unique(np.concatenate([keys, found]), return_inverse=True)
        counts = np.bincount(at, np.concatenate([counts, n]), len(keys)).astype(np.int64)
        if len(keys) > HELD_TILES:
            yield pa.RecordBatch.from_arrays([pa.array(keys), pa.array(counts)], names=["key", "n"])
            keys, counts = np.zeros(0, np.int64), np.zeros(0, np.int64)
    yield pa.RecordBatch.from_arrays([pa.array(keys), pa.array(counts)], names=["key", "n"])


def xyz_pyramid(points: DataFrame, zmin: int = 6, zmax: int = 14) -> DataFrame:
    """(z, x, y, cells): how many cells with data each Web-Mercator tile covers, for all zoom levels; ``points`` has lon, lat and value.

    Tiles of the finest level are counted in each task and put in the order of their Morton numbers, of which a coarser tile's is how its
    tiles' begin. One pass over each range of numbers then sums up all levels; only the first and last tile of each level in a range may go
    on in another, and only these are summed up again."""
    key = G.morton(*G.xyz_tile(F.col("lon"), F.col("lat"), F.lit(zmax)), zmax)
    finest = points.where("value IS NOT NULL").select(key.alias("key")).mapInArrow(counted_tiles, "key long, n long")

    def rolled(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        levels = list(range(zmin, zmax + 1))
        open_: dict[int, tuple[int, int, bool]] = {}  # the tile at hand, its cells so far, and whether it is the range's first

        def rows(z: int, tiles: list, cells: list, edges: list) -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array([z] * len(tiles), pa.int32()), pa.array(tiles, pa.int64()), pa.array(cells, pa.int64()), pa.array(edges, pa.bool_())], names=["z", "key", "cells", "edge"])

        for batch in batches:
            if not batch.num_rows:
                continue
            keys, n = batch.column(0).to_numpy(), batch.column(1).to_numpy()
            for z in levels:
                tiles = keys >> 2 * (zmax - z)
                starts = np.flatnonzero(np.concatenate([[True], tiles[1:] != tiles[:-1]]))
                names, sums = tiles[starts].tolist(), np.add.reduceat(n, starts).tolist()
                edges = [z not in open_] + [False] * (len(names) - 1)
                if z in open_:
                    tile, cells, first = open_[z]
                    if tile == names[0]:
                        sums[0] += cells
                        edges[0] = first
                    else:
                        names, sums, edges = [tile, *names], [cells, *sums], [first, *edges]
                open_[z] = names[-1], sums[-1], edges[-1]
                yield rows(z, names[:-1], sums[:-1], edges[:-1])
        for z, (tile, cells, _) in open_.items():
            yield rows(z, [tile], [cells], [True])

    found = stored(finest.repartitionByRange("key").sortWithinPartitions("key").mapInArrow(rolled, "z int, key long, cells long, edge boolean"), "tiles")
    joined = found.where("edge").groupBy("z", "key").agg(F.sum("cells").alias("cells"))
    x, y = G.from_morton(F.col("key"), zmax)
    return found.where("NOT edge").select("z", "key", "cells").unionByName(joined).select("z", x.alias("x"), y.alias("y"), "cells")


def value_range(pixels: DataFrame, grids: DataFrame, limit: int = 65_535) -> DataFrame:
    """Per tile: size, nodata, smallest and largest value, cells, and how many values are above ``limit``."""
    stats = pixels.groupBy("tile").agg(F.min("value").alias("min_value"), F.max("value").alias("max_value"), F.count(F.lit(1)).alias("cells"), F.count_if(F.col("value") > limit).alias("over_limit"))
    return stats.join(grids.select("tile", "nrows", "ncols", "nodata"), "tile")
