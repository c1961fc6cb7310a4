"""Joins and choices between boxes, rings and counties."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from terrasheaf.functions.geometry import ring_bbox
from terrasheaf.functions.keys import state_code
from terrasheaf.operators.grid import ring_spans
from terrasheaf.operators.spans import overlaps, shared_cells
from terrasheaf.runtime import split_crowded

BOX = ["minx", "miny", "maxx", "maxy"]


#: A cell with more boxes or features than this is split between tasks, and a task takes so many rows of cells at a time.
CROWDED_BOXES, TASK_BOXES = 100_000, 200_000


def bbox_intersect_join(boxes: DataFrame, features: DataFrame, cell: float, keys: tuple[str, str] = ("box_id", "feature_id")) -> DataFrame:
    """Distinct pairs of boxes that touch; a box with a null side touches nothing.

    Both sides are dealt to the cells of a pyramid of grids, the finest of ``cell``: a box to those it meets on the level of its own size, four
    at most, and to those of larger levels that the other side has. Two boxes meet on the larger one's level, in the one cell that holds the
    lower left corner of what both share, so nothing needs to be made distinct afterwards. A task takes whole cells and sweeps over each from
    left to right, so it compares only boxes that share some of the x axis. A crowded cell is split by its boxes and by its features."""
    size = F.greatest(F.col("maxx") - F.col("minx"), F.col("maxy") - F.col("miny")) / cell
    level = F.when(size > 1, F.ceil(F.log2(size))).otherwise(0).cast("int")
    sides = [df.where(" AND ".join(f"{c} IS NOT NULL" for c in BOX)).select(F.col(k).alias("key"), *(F.col(c).cast("double").alias(c) for c in BOX), level.alias("level")) for df, k in zip((boxes, features), keys, strict=True)]
    levels = sides[0].select("level", F.lit(0).alias("side")).unionByName(sides[1].select("level", F.lit(1).alias("side"))).distinct().collect()  # as many as powers of two between box sizes

    def dealt(df: DataFrame, others: list[int]) -> DataFrame:
        on = F.array_distinct(F.concat(F.array("level"), F.filter(F.array(*map(F.lit, others)).cast("array<int>"), lambda x: x > F.col("level"))))
        rows = df.withColumn("on", F.explode(on)).withColumn("side", F.pow(F.lit(2.0), F.col("on")) * cell)
        index = lambda c: F.floor(F.col(c) / F.col("side")).cast("long")
        rows = rows.withColumn("bx", F.explode(F.sequence(index("minx"), index("maxx"))))
        return rows.withColumn("by", F.explode(F.sequence(index("miny"), index("maxy")))).drop("side")

    spot = ["on", "bx", "by"]
    a, b = (dealt(df, sorted(r["level"] for r in levels if r["side"] == 1 - k)) for k, df in enumerate(sides))
    one, none = F.lit(1).alias("n"), F.lit(0).alias("m")
    counts = a.select(*spot, one, none).unionByName(b.select(*spot, F.lit(0).alias("n"), F.lit(1).alias("m"))).groupBy(*spot).agg(F.sum("n").alias("n"), F.sum("m").alias("m"))
    total, most = counts.agg(F.sum(F.col("n") + F.col("m")), F.max(F.greatest("n", "m"))).first()
    by = spot
    if (most or 0) > CROWDED_BOXES:
        a, b, by = split_crowded(a, b, by, CROWDED_BOXES)
        b, a, by = split_crowded(b, a, by, CROWDED_BOXES)
    buckets = 1 + (total or 0) // TASK_BOXES
    a, b = (df.select(*by, "key", *BOX, "level", F.pmod(F.xxhash64(*by), F.lit(buckets)).alias("bucket")) for df in (a, b))
    names = list(keys)

    def swept(here: pa.Table, there: pa.Table) -> pa.Table:
        x, y = ({c: t.column(c).to_numpy() for c in t.column_names if c != "key"} for t in (here, there))
        found = [(np.zeros(0, np.int64), np.zeros(0, np.int64))]
        if here.num_rows and there.num_rows:
            cells = np.concatenate([np.stack([t[c] for c in by], 1) for t in (x, y)]).astype(np.int64)
            code = np.unique(cells, axis=0, return_inverse=True)[1].reshape(-1)
            edges = np.unique(np.concatenate([t[c] for t in (x, y) for c in ("minx", "maxx")]))
            rank = lambda v: np.searchsorted(edges, v)
            n = here.num_rows
            for i, j, _ in overlaps(code[:n], rank(x["minx"]), rank(x["maxx"]), code[n:], rank(y["minx"]), rank(y["maxx"])):
                side = 2.0 ** x["on"][i] * cell
                corner = [np.floor(np.maximum(x[c][i], y[c][j]) / side) for c in ("minx", "miny")]
                ours = (corner[0] == x["bx"][i]) & (corner[1] == x["by"][i]) & (np.maximum(x["level"][i], y["level"][j]) == x["on"][i])
                ours &= (x["miny"][i] <= y["maxy"][j]) & (y["miny"][j] <= x["maxy"][i])
                found.append((i[ours], j[ours]))
        i, j = (np.concatenate(v) for v in zip(*found, strict=True))
        return pa.table([here.column("key").take(pa.array(i)), there.column("key").take(pa.array(j))], names=names)

    schema = ", ".join(f"`{k}` {dict(df.dtypes)[k]}" for k, df in zip(keys, (boxes, features), strict=True))
    return a.groupBy("bucket").cogroup(b.groupBy("bucket")).applyInArrow(swept, schema)


def select_intersecting(items: DataFrame, selector: DataFrame, cell: float) -> DataFrame:
    """Items whose box meets a selector's."""
    hit = bbox_intersect_join(items, selector, cell).select("box_id").distinct()
    return items.join(hit, "box_id", "left_semi")


def bounds_prefilter(df: DataFrame, other: DataFrame) -> DataFrame:
    """Rows whose box overlaps the extent of the other side, one row that is broadcast."""
    extent = other.agg(F.min("minx").alias("x0"), F.min("miny").alias("y0"), F.max("maxx").alias("x1"), F.max("maxy").alias("y1"))
    return df.join(F.broadcast(extent), (F.col("minx") <= F.col("x1")) & (F.col("maxx") >= F.col("x0")) & (F.col("miny") <= F.col("y1")) & (F.col("maxy") >= F.col("y0"))).drop("x0", "y0", "x1", "y1")


def with_bbox(rings: DataFrame) -> DataFrame:
    return rings.withColumn("__b", ring_bbox(F.col("ring"))).select("*", *(F.col(f"__b.{n}").alias(n) for n in BOX)).drop("__b")


def state_filter(df: DataFrame, states: list[str], columns: list[str]) -> DataFrame:
    """Rows of the allowed states by the first state-like column; without one, all rows."""
    found = next((c for c in columns if c in df.columns), None)
    return df.where(state_code(F.col(found), found).isin([s.upper() for s in states])) if found else df


def tile_scope(df: DataFrame, scope: DataFrame) -> DataFrame:
    return df.join(scope.select("tile").distinct(), "tile", "left_semi")


def overlay_area(fields: DataFrame, others: DataFrame, grids: DataFrame, field_key: str, other_key: str) -> DataFrame:
    """(field, other, overlap_area, pct): areas shared by rings of two tables, measured in cells of one grid. The error of an area is at most
    its perimeter times the cell size.

    Both become spans of their rows; a sweep over the spans of some rows gives what each two share, so rows grow with perimeters."""
    mine, theirs = ring_spans(fields, grids, [field_key]), ring_spans(others, grids, [other_key])
    shared = shared_cells(mine, theirs, field_key, other_key)
    size = mine.groupBy("tile", field_key).agg(F.sum(F.col("high") - F.col("low") + 1).alias("all_cells"))
    area = F.abs(F.col("dx") * F.col("dy"))
    return shared.join(size, ["tile", field_key]).join(grids, "tile").select("tile", field_key, other_key, (F.col("cells") * area).alias("overlap_area"), (100.0 * F.col("cells") / F.col("all_cells")).alias("pct"))


def best_county(overlap: DataFrame, key: list[str]) -> DataFrame:
    """Per field the county with the largest overlap (ties: the lowest code), its percentage, and how many counties it meets."""
    best = F.min_by(F.struct("fips", "pct"), F.struct(-F.col("overlap_area"), "fips"))
    return overlap.groupBy(*key).agg(best.alias("b"), F.count_distinct("fips").alias("county_match_count")).select(*key, F.col("b.fips").alias("FIPS"), F.col("b.pct").alias("county_overlap_pct"), "county_match_count")


def county_match_count(overlap: DataFrame, key: list[str]) -> DataFrame:
    return overlap.groupBy(*key).agg(F.count_distinct("fips").alias("county_match_count"))


def attach_county(polygons: DataFrame, best: DataFrame, key: list[str]) -> DataFrame:
    """County attributes on every polygon; one without a county stays."""
    return polygons.join(best, key, "left")


def dissolve_fields(cells: DataFrame, keys: list[str], attributes: list[str], cell_area: float) -> DataFrame:
    """Parts of a field as one: its distinct cells, their area, and the least non-null value of each other column."""
    return cells.groupBy(*keys).agg(F.count_distinct("row", "col").alias("cells"), *(F.min(a).alias(a) for a in attributes)).withColumn("area", F.col("cells") * cell_area)
