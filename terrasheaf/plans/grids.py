"""Queries: pixel tables, rings, zonal statistics, overlays and crop composition."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from terrasheaf.functions import geometry as G
from terrasheaf.functions.keys import FIELD_NAMESPACE
from terrasheaf.operators import cropyear as Y
from terrasheaf.operators import fields as B
from terrasheaf.operators import grid as R
from terrasheaf.operators import spatial as P
from terrasheaf.operators import zonal as Z
from terrasheaf.plans.assembly import rounded
from terrasheaf.plans.registry import query, uuid_sql
from terrasheaf.plans.standins import Tables
from terrasheaf.runtime import stored


def ring(kind: str = "shape") -> F.Column:
    """A closed ring from a box: a rectangle, or a triangle where ``shape`` is 2."""
    p = lambda x, y: F.struct(F.col(x).cast("double").alias("x"), F.col(y).cast("double").alias("y"))
    box = F.array(p("minx", "miny"), p("maxx", "miny"), p("maxx", "maxy"), p("minx", "maxy"), p("minx", "miny"))
    triangle = F.array(p("minx", "miny"), p("maxx", "miny"), p("minx", "maxy"), p("minx", "miny"))
    return F.when(F.col(kind) == 2, triangle).otherwise(box) if kind else box


def rings(t: Tables) -> DataFrame:
    return t.ring_boxes.select("tile", "field_id", ring().alias("ring"), "minx", "miny", "maxx", "maxy")


# A cell's centre lies in a box, or under the box's diagonal for a triangle.
IN_RING = (
    "(col + 0.5) * 30 > minx AND (col + 0.5) * 30 < maxx AND (row + 0.5) * 30 > miny AND (row + 0.5) * 30 < maxy "
    "AND (shape <> 2 OR ((col + 0.5) * 30 - minx) / (maxx - minx) + ((row + 0.5) * 30 - miny) / (maxy - miny) < 1)"
)
ZONES = f"SELECT b.tile, b.field_id, p.row, p.col, p.value FROM {{value_pixels}} p JOIN {{ring_boxes}} b ON p.tile = b.tile AND {IN_RING}"


@query(f"SELECT tile, field_id, row, col, value FROM ({ZONES})")
def D7_rasterize_join(t: Tables) -> DataFrame:
    return R.zonal_join(rings(t), t.grids, t.value_pixels, ["field_id"]).select("tile", "field_id", "row", "col", "value")


@query(f"SELECT tile, field_id, round(avg(value), 6) AS mean, count(*) AS pixel_count FROM ({ZONES}) GROUP BY 1, 2")
def E1_zonal_mean(t: Tables) -> DataFrame:
    return Z.zonal_stats(rings(t), t.grids, t.value_pixels, ["tile", "field_id"])


@query(f"SELECT tile, field_id, round(avg(value), 6) AS mean, max(value) AS max, count(*) AS pixel_count FROM ({ZONES}) GROUP BY 1, 2")
def E2_zonal_mean_max(t: Tables) -> DataFrame:
    return Z.zonal_stats(rings(t), t.grids, t.value_pixels, ["tile", "field_id"], ("mean", "max"))


@query(
    "SELECT tile_field_ID, year, tillage_0_count AS t0_count, tillage_1_count AS t1_count, tillage_na_count AS na_count, pixel_count, "
    "tillage_0_prop AS t0_prop, tillage_1_prop AS t1_prop, tillage_na_prop AS na_prop FROM {tillage_wide}"
)
def E3_zonal_value_counts(t: Tables) -> DataFrame:
    return Z.value_counts(t.lines, ["tile_field_ID", "year"], F.col("l_returnflag"), {"t0": "R", "t1": "A"})


@query(
    "SELECT c.tile, value AS field_id, pixel_count, CASE WHEN value IS NOT NULL THEN concat(c.tile, '_', CAST(value AS VARCHAR)) END AS primary_key, CASE "
    "WHEN value IS NULL THEN 'missing_raster' ELSE 'ok' END AS status FROM (SELECT DISTINCT tile FROM {cells} UNION SELECT 'h09v09') c LEFT "
    "JOIN (SELECT tile, value, count(*) AS pixel_count FROM {field_pixels} WHERE value > 0 GROUP BY 1, 2) p ON c.tile = p.tile"
)
def E5_field_pixel_counts(t: Tables) -> DataFrame:
    extra = t.grids.select(F.lit("h09v09").alias("tile")).distinct()
    return Z.field_pixel_counts(t.field_pixels, t.grids.select("tile").unionByName(extra))


PAIR_COUNTS = (
    "SELECT f.value AS field_id, c.value AS crop_id, 2010 AS year, count(*) AS pixel_count FROM {field_pixels} f JOIN {crop_pixels} c ON f.tile = c.tile "
    "AND f.row = c.row AND f.col = c.col WHERE f.value <> 0 AND c.value <> 0 GROUP BY 1, 2"
)
SUMMARY = (
    "SELECT *, sum(pixel_count) OVER (PARTITION BY field_id, year) AS total, first_value(crop_id) OVER (PARTITION BY field_id, year "
    "ORDER BY pixel_count DESC, crop_id) AS top, first_value(pixel_count) OVER (PARTITION BY field_id, year ORDER BY pixel_count DESC, crop_id) AS top_n "
    f"FROM ({PAIR_COUNTS})"
)


def counts(t: Tables) -> DataFrame:
    return Y.pair_counts(t.field_pixels, t.crop_pixels, F.lit(2010))


@query(PAIR_COUNTS)
def E6_pair_counts(t: Tables) -> DataFrame:
    return counts(t)


@query(
    "SELECT field_id, year, crop_id, pixel_count, CAST(total AS BIGINT) AS total_field_pixels, round(pixel_count / total, 9) AS share, "
    f"crop_id = top AS is_dominant, top AS dominant_crop_id, round(top_n / total, 9) AS dominant_crop_share FROM ({SUMMARY})"
)
def E7_crop_year_summary(t: Tables) -> DataFrame:
    return rounded(Y.crop_year_summary(counts(t)), 9)


@query(f"SELECT field_id, year, crop_id, top AS dominant_crop_id FROM ({SUMMARY})")
def F3_dominant_crop(t: Tables) -> DataFrame:
    return Y.dominant_crop(counts(t))


@query(f"SELECT field_id, year, crop_id, round(pixel_count / total, 9) AS share FROM ({SUMMARY})")
def F4_share_of_field(t: Tables) -> DataFrame:
    return rounded(Y.share_of_field(counts(t)), 9)


@query(
    "SELECT c.field_id, c.crop_id, c.year, c.pixel_count, n.n_name AS crop_name, c.pixel_count * 900e0 AS area_m2, "
    f"round(c.pixel_count * 900e0 / 4046.8564224, 6) AS acres FROM ({PAIR_COUNTS}) c LEFT JOIN {{nation}} n ON c.crop_id = n.n_nationkey"
)
def B26_crop_units(t: Tables) -> DataFrame:
    codes = t.nation.select(F.col("n_nationkey").cast("long").alias("crop_id"), F.col("n_name").alias("crop_name"))
    return rounded(Y.crop_units(counts(t), 900.0, codes)).select("field_id", "crop_id", "year", "pixel_count", "crop_name", "area_m2", "acres")


CHECKS = f"""WITH s AS (SELECT *, pixel_count / total AS share, crop_id = top AS dominant FROM ({SUMMARY})),
f AS (SELECT field_id, year, sum(share) AS shares, count(*) FILTER (WHERE dominant) AS dominants, count(*) AS n, count(DISTINCT crop_id) AS crops FROM s GROUP BY 1, 2)
SELECT a.*, b.* FROM (SELECT count(*) > 0 AS non_empty, bool_and(year = 2010) AS year_ok, bool_and(pixel_count > 0) AS counts_positive,
    bool_and(share >= 0 AND share <= 1) AS shares_in_range, bool_and(crop_id >= 0 AND crop_id <= 65535) AS crop_ids_in_range, bool_and(field_id > 0) AS field_ids_positive,
    count(*) = (SELECT count(*) FROM ({PAIR_COUNTS})) AS rows_match FROM s) a
CROSS JOIN (SELECT bool_and(abs(shares - 1) < 1e-6) AS shares_sum_to_one, bool_and(dominants = 1) AS one_dominant, bool_and(n = crops) AS rows_unique FROM f) b"""


@query(f"SELECT * FROM ({CHECKS})")
def I4_validate_crop_year(t: Tables) -> DataFrame:
    found = stored(counts(t), "counts")
    return Y.validate_crop_year(found, Y.crop_year_summary(found), 2010)


@query("""SELECT (SELECT count(*) FROM {corn} WHERE year <> 1997) + (SELECT count(*) FROM {corn} WHERE year = 1999) AS rows, (SELECT count(*) FROM {corn} WHERE year = 1999) AS duplicate_keys,
(SELECT count(*) FROM (SELECT DISTINCT tile_coord FROM {keys}) a CROSS JOIN range(1995, 2000) y(year) WHERE (tile_coord, year) NOT IN (SELECT tile_coord, year FROM {corn} WHERE year <> 1997)) AS missing_units, (SELECT count(*) FROM {corn} WHERE year > 1999) AS rows_outside""")
def I5_merge_and_validate(t: Tables) -> DataFrame:
    years = t.spark.range(1995, 2000).select(F.col("id").cast("int").alias("year"))
    units = Z.work_units(t.keys.select("tile_coord"), years)
    corn = t.corn.select("tile_coord", "tile_field_ID", "year")
    return Y.merge_checks([corn.where("year < 1997"), corn.where("year > 1997"), corn.where("year = 1999")], units, ["tile_field_ID", "year"])


@query("SELECT tile, mukey, count(*) OVER (PARTITION BY tile) AS mukeys FROM (SELECT DISTINCT tile, value AS mukey FROM {field_pixels} WHERE value > 0)")
def E8_tile_mukeys(t: Tables) -> DataFrame:
    return Z.tile_mukeys(t.field_pixels)


@query(
    "SELECT m.tile_field_id, mukey, cells * 900e0 AS overlap_area, round(100 * cells * 900e0 / area, 6) AS pct_overlap FROM {field_mukey} m "
    "JOIN (SELECT tile_field_id, sum(cells) * 1000e0 AS area FROM {field_mukey} GROUP BY 1) a ON m.tile_field_id = a.tile_field_id"
)
def E9_overlap_pct(t: Tables) -> DataFrame:
    areas = t.field_mukey.groupBy("tile_field_id").agg((F.sum("cells") * 1000.0).alias("area"))
    return rounded(Z.overlap_pct(t.field_mukey.select("tile_field_id", "mukey", "cells"), areas, 900.0, "tile_field_id"))


@query(
    "SELECT tile, value, count(DISTINCT (row, col)) AS cells, min(tile) AS first_tile, count(DISTINCT (row, col)) * 900e0 AS area FROM {field_pixels} "
    "WHERE value > 0 GROUP BY 1, 2"
)
def E10_dissolve_fields(t: Tables) -> DataFrame:
    rows = t.field_pixels.where("value > 0").withColumn("first_tile", F.col("tile"))
    return P.dissolve_fields(rows.unionByName(rows), ["tile", "value"], ["first_tile"], 900.0)


@query(
    "SELECT tile, value, count(*) AS cells, min(row) AS min_row, max(row) AS max_row, min(col) AS min_col, max(col) AS max_col FROM {field_pixels} "
    "WHERE value <> 0 GROUP BY 1, 2"
)
def E12_field_cells(t: Tables) -> DataFrame:
    return R.field_cells(t.field_pixels)


@query(
    "SELECT tile_coord, field_id, CAST(substr(day, 1, 4) AS INT) AS year, arg_max(CASE WHEN substr(day, 5, 2) = '07' THEN vpdmax_mean END, CASE "
    "WHEN substr(day, 5, 2) = '07' THEN source * 100 + line END) AS vpdmax_7, arg_max(CASE WHEN substr(day, 5, 2) = '08' THEN vpdmax_mean END, CASE "
    "WHEN substr(day, 5, 2) = '08' THEN source * 100 + line END) AS vpdmax_8 FROM {monthly} WHERE substr(day, 5, 2) IN ('07', '08') GROUP BY 1, 2, 3"
)
def E27_vpd_pivot(t: Tables) -> DataFrame:
    return Z.vpd_pivot(t.monthly)


@query("SELECT row, col, arg_min(value, tile) AS value FROM {value_pixels} GROUP BY 1, 2")
def E26_mosaic(t: Tables) -> DataFrame:
    return R.mosaic(t.value_pixels.withColumn("source_order", F.col("tile")))


@query(
    "SELECT z, CAST(floor(x / pow(2, 14 - z)) AS INT) AS x, CAST(floor(y / pow(2, 14 - z)) AS INT) AS y, count(*) AS cells "
    "FROM (SELECT CAST(floor((-98 + col * 0.01 + 180) / 360 * 16384) AS INT) AS x, "
    "CAST(floor((1 - ln(tan(radians(35 + row * 0.005)) + 1 / cos(radians(35 + row * 0.005))) / pi()) / 2 * 16384) AS INT) AS y FROM {value_pixels}) CROSS "
    "JOIN range(6, 15) r(z) GROUP BY 1, 2, 3"
)
def E33_xyz_pyramid(t: Tables) -> DataFrame:
    points = t.value_pixels.select((F.lit(-98.0) + F.col("col") * 0.01).alias("lon"), (F.lit(35.0) + F.col("row") * 0.005).alias("lat"), "value")
    return R.xyz_pyramid(points).withColumn("z", F.col("z").cast("long"))


@query("SELECT tile, row, col, value FROM {field_pixels} WHERE value > 0")
def C8_valid_cells(t: Tables) -> DataFrame:
    return R.valid_cells(t.field_pixels, t.grids).select("tile", "row", "col", "value")


@query("SELECT tile, row, col, value FROM {field_pixels} WHERE value <> 0")
def A4_read_pixels(t: Tables) -> DataFrame:
    from terrasheaf.sources.tables import read_pixels

    return read_pixels(t.field_pixels, t.grids).select("tile", "row", "col", "value")


@query(
    "SELECT f.tile, f.row, f.col, f.value AS field_id, c.value AS value FROM {field_pixels} f JOIN {crop_pixels} c ON f.tile = c.tile AND f.row = c.row "
    "AND f.col = c.col"
)
def D8_pixel_pair_join(t: Tables) -> DataFrame:
    return R.pixel_pair_join(t.field_pixels, t.crop_pixels, t.grids, t.grids)


@query(
    "SELECT g.tile, g.r AS row, g.c AS col, p.value FROM (SELECT tile, CAST(r AS INT) AS r, CAST(c AS INT) AS c FROM {grids} CROSS JOIN range(0, 666) a(r) "
    "CROSS JOIN range(0, 333) b(c)) g LEFT JOIN {field_pixels} p ON g.tile = p.tile AND p.row = CAST(floor((g.r + 0.5) * 90 / 30) AS INT) "
    "AND p.col = CAST(floor((g.c + 0.5) * 90 / 30) AS INT)"
)
def D9_align_to_grid(t: Tables) -> DataFrame:
    coarse = t.grids.select("tile", "x0", "y0", F.lit(90.0).alias("dx"), F.lit(90.0).alias("dy"), F.lit(333).alias("ncols"), F.lit(666).alias("nrows"))
    return R.align_to_grid(t.field_pixels, t.grids, coarse)


BOX_PAIRS = (
    "SELECT b.tile, b.field_id, c.fips FROM {ring_boxes} b JOIN {county_boxes} c ON b.tile = c.tile AND b.minx <= c.maxx AND c.minx <= b.maxx "
    "AND b.miny <= c.maxy AND c.miny <= b.maxy"
)


def boxes(t: Tables) -> tuple[DataFrame, DataFrame]:
    t.keep("blocks")  # both sides and each pass over them derive from it
    box = ["minx", "miny", "maxx", "maxy"]
    return t.ring_boxes.select(F.concat_ws("_", "tile", "field_id").alias("box_id"), *box), t.county_boxes.select(F.concat_ws("_", "tile", "fips").alias("feature_id"), *box)


@query(
    "SELECT DISTINCT concat(b.tile, '_', CAST(b.field_id AS VARCHAR)) AS box_id, concat(c.tile, '_', c.fips) AS feature_id FROM {ring_boxes} b "
    "JOIN {county_boxes} c ON b.minx <= c.maxx AND c.minx <= b.maxx AND b.miny <= c.maxy AND c.miny <= b.maxy"
)
def D10_bbox_intersect_join(t: Tables) -> DataFrame:
    a, b = boxes(t)
    return P.bbox_intersect_join(a, b, 6000.0)


@query(
    "SELECT DISTINCT concat(b.tile, '_', CAST(b.field_id AS VARCHAR)) AS box_id FROM {ring_boxes} b JOIN {county_boxes} c ON c.fips < '01021' "
    "AND b.minx <= c.maxx AND c.minx <= b.maxx AND b.miny <= c.maxy AND c.miny <= b.maxy"
)
def D12_select_intersecting(t: Tables) -> DataFrame:
    a, b = boxes(t)
    return P.select_intersecting(a, b.where(F.element_at(F.split("feature_id", "_"), 2) < "01021"), 6000.0).select("box_id")


@query(
    "SELECT b.tile, b.field_id FROM {ring_boxes} b, (SELECT min(minx) AS x0, min(miny) AS y0, max(maxx) AS x1, max(maxy) AS y1 FROM {county_boxes} "
    "WHERE fips <= '01021') e WHERE b.minx <= x1 AND b.maxx >= x0 AND b.miny <= y1 AND b.maxy >= y0"
)
def C10_bounds_prefilter(t: Tables) -> DataFrame:
    some = t.county_boxes.where("fips <= '01021'")  # the other side of the operation, a region of counties
    return P.bounds_prefilter(t.ring_boxes, some).select("tile", "field_id")


def cells_sql(boxes: str, keys: str, inside: str) -> str:
    """The cells of the grids (2000 rows of 1000 cells of 30 metres) whose centres lie in boxes."""
    rows = f"SELECT *, unnest(range(CAST(floor(miny / 30) AS BIGINT), CAST(ceil(maxy / 30) AS BIGINT) + 1)) AS row FROM {boxes}"
    both = f"SELECT *, unnest(range(CAST(floor(minx / 30) AS BIGINT), CAST(ceil(maxx / 30) AS BIGINT) + 1)) AS col FROM ({rows})"
    return f"SELECT tile, {keys}, row, col FROM ({both}) WHERE row BETWEEN 0 AND 1999 AND col BETWEEN 0 AND 999 AND {inside}"


MINE = cells_sql("{ring_boxes}", "field_id", IN_RING)
THEIRS = cells_sql("{county_boxes}", "fips", IN_RING.split(" AND (shape")[0])
OVERLAY = (
    "SELECT s.tile, s.field_id, s.fips, s.n * 900e0 AS overlap_area, 100e0 * s.n / a.n AS pct FROM (SELECT m.tile, m.field_id, c.fips, count(*) AS n "
    f"FROM ({MINE}) m JOIN ({THEIRS}) c ON m.tile = c.tile AND m.row = c.row AND m.col = c.col GROUP BY 1, 2, 3) s JOIN (SELECT tile, field_id, "
    f"count(*) AS n FROM ({MINE}) GROUP BY 1, 2) a ON s.tile = a.tile AND s.field_id = a.field_id"
)


def overlay(t: Tables) -> DataFrame:
    counties = t.county_boxes.select("tile", "fips", ring("").alias("ring"))
    return P.overlay_area(rings(t), counties, t.grids, "field_id", "fips")


@query(f"SELECT tile, field_id, fips, overlap_area, round(pct, 6) AS pct FROM ({OVERLAY})")
def D11_overlay_area(t: Tables) -> DataFrame:
    return rounded(overlay(t))


@query(
    "SELECT tile, field_id, arg_min(fips, (-overlap_area, fips)) AS FIPS, round(arg_min(pct, (-overlap_area, fips)), 6) AS county_overlap_pct, "
    f"count(DISTINCT fips) AS county_match_count FROM ({OVERLAY}) GROUP BY 1, 2"
)
def F2_best_county(t: Tables) -> DataFrame:
    return rounded(P.best_county(overlay(t), ["tile", "field_id"]))


@query(f"SELECT tile, field_id, count(DISTINCT fips) AS county_match_count FROM ({OVERLAY}) GROUP BY 1, 2")
def E11_county_match_count(t: Tables) -> DataFrame:
    return P.county_match_count(overlay(t), ["tile", "field_id"])


@query(
    f"SELECT b.tile, b.field_id, o.FIPS FROM {{ring_boxes}} b LEFT JOIN (SELECT tile, field_id, arg_min(fips, (-overlap_area, fips)) AS FIPS "
    f"FROM ({OVERLAY}) GROUP BY 1, 2) o ON b.tile = o.tile AND b.field_id = o.field_id"
)
def D14_attach_county(t: Tables) -> DataFrame:
    return P.attach_county(t.ring_boxes.select("tile", "field_id"), P.best_county(overlay(t), ["tile", "field_id"]).select("tile", "field_id", "FIPS"), ["tile", "field_id"])


@query("SELECT tile_coord, year FROM (SELECT DISTINCT tile_coord FROM {keys}) CROSS JOIN (SELECT DISTINCT year FROM {corn})")
def D13_work_units(t: Tables) -> DataFrame:
    return Z.work_units(t.keys.select("tile_coord"), t.corn.select("year"))


@query(
    "SELECT tile, row, col, value FROM {field_pixels} WHERE (tile, value) IN (SELECT tile, value FROM {field_pixels} GROUP BY 1, 2 HAVING count(*) > 3 "
    "AND value % 2 = 1)"
)
def D15_key_allowlist(t: Tables) -> DataFrame:
    keys = t.field_pixels.groupBy("tile", "value").agg(F.count(F.lit(1)).alias("n")).where("n > 3 AND value % 2 = 1").select("tile", "value")
    return R.key_allowlist(t.field_pixels, keys).select("tile", "row", "col", "value")


@query(
    "SELECT tile, moved = x0 AS aligned, x0 < moved + ncols * dx AND moved < x0 + ncols * dx AS overlapping FROM (SELECT *, CASE tile "
    "WHEN 'h00v01' THEN 15.0 WHEN 'h00v02' THEN 60000.0 ELSE x0 END AS moved FROM {grids})"
)
def I8_grid_check(t: Tables) -> DataFrame:
    moved = t.grids.withColumn("x0", F.when(F.col("tile") == "h00v01", 15.0).when(F.col("tile") == "h00v02", 60000.0).otherwise(F.col("x0")))
    return R.grid_check(t.grids, moved)


@query(
    "SELECT tile, min(value) AS min_value, max(value) AS max_value, count(*) AS cells, count(*) FILTER (WHERE value > 1500) AS over_limit, 2000 AS nrows, "
    "1000 AS ncols, CAST(0 AS BIGINT) AS nodata FROM {field_pixels} GROUP BY 1"
)
def I10_value_range(t: Tables) -> DataFrame:
    return R.value_range(t.field_pixels, t.grids, 1500)


@query("SELECT tile, CAST(900 AS DOUBLE) AS cell_area FROM {grids}")
def B19_pixel_area(t: Tables) -> DataFrame:
    return t.grids.select("tile", G.pixel_area(F.col("dx"), F.lit(0.0), F.lit(0.0), -F.col("dy")).alias("cell_area"))


@query("SELECT tile, x0 AS minx, y0 AS miny, x0 + ncols * dx AS maxx, y0 + nrows * dy AS maxy FROM {grids}")
def B18_grid_bbox(t: Tables) -> DataFrame:
    return t.grids.select("tile", G.grid_bbox(*(F.col(c) for c in ("x0", "y0", "dx", "dy", "ncols", "nrows"))).alias("b")).select("tile", "b.*")


@query("SELECT tile, field_id, (maxx - minx) * (maxy - miny) / CASE WHEN shape = 2 THEN 2.0 ELSE 1.0 END AS area FROM {ring_boxes}")
def B25_polygon_area(t: Tables) -> DataFrame:
    return rings(t).select("tile", "field_id", G.polygon_area(F.col("ring")).alias("area"))


@query("SELECT tile, row, col, CASE WHEN value = 0 THEN 0 WHEN value IN (1, 2, 3, 101) THEN 0 ELSE 255 END AS mask FROM {field_pixels}")
def B22_value_mask(t: Tables) -> DataFrame:
    return t.field_pixels.select("tile", "row", "col", G.value_mask(F.col("value"), [1, 2, 3, 101], F.lit(0), invert=True).alias("mask"))


@query(
    "SELECT tile, row, col, round(radians(-98 + col * 0.01) * 6378137, 3) AS x, round(ln(tan(pi() / 4 + radians(35 + row * 0.005) / 2)) * 6378137, "
    "3) AS y, round(-98 + col * 1e-2, 6) AS lon, round(35 + row * 5e-3, 6) AS lat FROM {cells}"
)
def B20_reproject_xy(t: Tables) -> DataFrame:
    lon, lat = F.lit(-98.0) + F.col("col") * 0.01, F.lit(35.0) + F.col("row") * 0.005
    x, y = G.reproject_xy(lon, lat, 4326, 3857)
    ax, ay = G.reproject_xy(lon, lat, 4326, 5070)
    back = G.reproject_xy(ax, ay, 5070, 4326)
    return t.cells.select("tile", "row", "col", F.round(x, 3).alias("x"), F.round(y, 3).alias("y"), F.round(back[0], 6).alias("lon"), F.round(back[1], 6).alias("lat"))


@query(
    "SELECT tile, row, col, CAST(floor((-98 + col * 0.01 + 180) / 360 * 1024) AS INT) AS x, "
    "CAST(floor((1 - ln(tan(radians(35 + row * 0.005)) + 1 / cos(radians(35 + row * 0.005))) / pi()) / 2 * 1024) AS INT) AS y FROM {cells}"
)
def B21_xyz_tile(t: Tables) -> DataFrame:
    x, y = G.xyz_tile(F.lit(-98.0) + F.col("col") * 0.01, F.lit(35.0) + F.col("row") * 0.005, F.lit(10))
    return t.cells.select("tile", "row", "col", x.alias("x"), y.alias("y"))


@query("SELECT tile_coord, field_id, day, round(vpdmax_mean, 5) AS corn_mean, 'EPSG:5070' AS crs FROM {monthly}")
def B24_zonal_columns(t: Tables) -> DataFrame:
    return Z.zonal_columns(t.monthly, [("tile_coord", "attribute", "tile_coord"), ("field_id", "attribute", "field_id"), ("day", "attribute", "day"), ("corn_mean", "statistic", ("vpdmax_mean", 5)), ("crs", "literal", "EPSG:5070")])


@query("SELECT tile_field_ID, year, month, l_quantity FROM {lines} WHERE month IN (7, 8)")
def C5_month_in(t: Tables) -> DataFrame:
    return Z.month_in(t.lines, [7, 8]).select("tile_field_ID", "year", "month", "l_quantity")


@query("SELECT mukey, state_code, nccpi3soy FROM {valu1} WHERE state_code = 'IL'")
def C6_state_filter(t: Tables) -> DataFrame:
    return P.state_filter(t.valu1.select("mukey", "state_code", "nccpi3soy"), ["il"], ["areasymbol", "state_code"])


@query("SELECT tile, row, col, value FROM {field_pixels} WHERE tile IN ('h00v00', 'h00v02')")
def C7_tile_scope(t: Tables) -> DataFrame:
    return P.tile_scope(t.field_pixels, t.grids.where("tile <> 'h00v01'")).select("tile", "row", "col", "value")


def features(t: Tables) -> DataFrame:
    """Polygons as they come: some without a field or a tile, some in two sources."""
    rows = rings(t).select(F.col("tile").alias("tile_coord"), F.when(F.col("field_id") % 13 == 0, "").otherwise(F.col("field_id").cast("string")).alias("field_id"), F.lit("2008").alias("valid_start"), F.lit(None).cast("string").alias("valid_end"), "ring", F.col("field_id").alias("n"))
    named = rows.withColumn("source_name", F.lit("a")).unionByName(rows.where("n % 4 = 0").withColumn("source_name", F.lit("b")))
    return named.withColumn("tile_field_id", F.concat_ws("_", "tile_coord", "field_id"))


FEATURES = (
    "SELECT tile AS tile_coord, CASE WHEN field_id % 13 = 0 THEN '' ELSE CAST(field_id AS VARCHAR) END AS field_id, 'a' AS source_name FROM {ring_boxes} "
    "UNION ALL SELECT tile, CASE WHEN field_id % 13 = 0 THEN '' ELSE CAST(field_id AS VARCHAR) END, 'b' FROM {ring_boxes} WHERE field_id % 4 = 0"
)


@query(f"SELECT tile_coord, field_id, source_name FROM ({FEATURES}) WHERE field_id <> ''")
def C12_non_missing_id(t: Tables) -> DataFrame:
    return B.non_missing_id(features(t)).select("tile_coord", "field_id", "source_name")


FIELDS = f"(SELECT tile_coord, field_id AS source_field_id, count(*) AS boundary_count, string_agg(DISTINCT source_name, ';' ORDER BY source_name) AS source_names FROM ({FEATURES}) WHERE field_id <> '' GROUP BY 1, 2)"


@query(uuid_sql(FIELD_NAMESPACE, "concat('src|', tile_coord, '|', source_field_id)", "'src' AS source, tile_coord, source_field_id, boundary_count, source_names", FIELDS, "field_id"))
def E13_field_index(t: Tables) -> DataFrame:
    return B.field_index(B.field_boundaries(features(t), "src", "30m"))


@query(
    "SELECT count(*) AS rows, count(*) FILTER (WHERE nullif(trim(tile_coord), '') IS NULL) AS missing_tile, count(*) FILTER (WHERE nullif(trim(field_id), "
    "'') IS NULL) AS missing_field, count(*) FILTER (WHERE nullif(trim(concat(tile_coord, '_', field_id)), '') IS NULL) AS missing_id, "
    f"count(DISTINCT tile_coord) AS tiles, count(DISTINCT (tile_coord, field_id)) AS ids FROM ({FEATURES})"
)
def E35_field_rollup_checks(t: Tables) -> DataFrame:
    return B.field_rollup_checks(features(t))


RING_HASHES = (
    "SELECT tile, field_id, sha256(array_to_string(list_transform(pts, lambda p: concat(CAST(CAST(p[1] AS DOUBLE) AS VARCHAR), ' ', "
    "CAST(CAST(p[2] AS DOUBLE) AS VARCHAR))), ',')) AS geometry_hash FROM (SELECT tile, field_id, CASE WHEN shape = 2 THEN [[minx, miny], [maxx, miny], "
    "[minx, maxy], [minx, miny]] ELSE [[minx, miny], [maxx, miny], [maxx, maxy], [minx, maxy], [minx, miny]] END AS pts FROM {ring_boxes})"
)


@query(RING_HASHES)
def B15_geometry_hash(t: Tables) -> DataFrame:
    from terrasheaf.functions.keys import geometry_hash

    return rings(t).select("tile", "field_id", geometry_hash(F.col("ring")).alias("geometry_hash"))
