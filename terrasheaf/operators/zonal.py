"""Zonal statistics and what is made of them."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from terrasheaf.functions.keys import year_month
from terrasheaf.operators.grid import ring_spans
from terrasheaf.operators.spans import span_statistics


def zonal_columns(df: DataFrame, spec: list[tuple[str, str, object]]) -> DataFrame:
    """A projection from (name, kind, source): a literal, an attribute, or a statistic as (column, digits)."""
    made = {"literal": lambda s: F.lit(s), "attribute": lambda s: F.col(s), "statistic": lambda s: F.round(F.col(s[0]), s[1])}
    return df.select(*(made[kind](source).alias(name) for name, kind, source in spec))


def month_in(df: DataFrame, months: list[int], column: str = "month") -> DataFrame:
    return df.where(F.col(column).isin(months))


def work_units(tiles: DataFrame, periods: DataFrame) -> DataFrame:
    """Each tile with each period. Both sides are short lists of names; the result is the plan of work and its size is their product."""
    return tiles.distinct().crossJoin(F.broadcast(periods.distinct()))


def zonal_stats(rings: DataFrame, grids: DataFrame, pixels: DataFrame, keys: list[str], stats: tuple[str, ...] = ("mean",), digits: int = 6) -> DataFrame:
    """Mean (and max) of the pixels in each ring with their number, by ``keys`` (tile and columns of ``rings``); rings without a pixel are left
    out, a null value counts as a pixel only. Sums are two look-ups for each row of a ring in the running sums of its block of pixels."""
    sums = span_statistics(ring_spans(rings, grids, keys), pixels, keys, "max" in stats)
    top = F.when(F.col("known") > 0, F.col("top")).cast(dict(pixels.dtypes)["value"])
    made = {"mean": F.round(F.try_divide(F.col("s"), F.col("known")), digits).alias("mean"), "max": F.round(top, digits).alias("max")}
    return sums.select(*keys, *(made[s] for s in stats), F.col("n").alias("pixel_count"))


def value_counts(rows: DataFrame, keys: list[str], value: Column, values: dict[str, object]) -> DataFrame:
    """Counts and proportions of each value and of everything else ("na"), by ``keys``."""
    other = F.lit(True)
    for v in values.values():
        other = other & ~value.eqNullSafe(F.lit(v))
    counts = [F.count_if(value == v).alias(f"{n}_count") for n, v in values.items()] + [F.count_if(other).alias("na_count"), F.count(F.lit(1)).alias("pixel_count")]
    done = rows.groupBy(*keys).agg(*counts)
    return done.select("*", *(F.round(F.col(f"{n}_count") / F.col("pixel_count"), 6).alias(f"{n}_prop") for n in (*values, "na")))


def field_pixel_counts(pixels: DataFrame, tiles: DataFrame) -> DataFrame:
    """Pixels per field of each tile with a primary key; a tile without pixels is one row of status missing_raster."""
    counts = pixels.where("value > 0").groupBy("tile", "value").agg(F.count(F.lit(1)).alias("pixel_count"))
    joined = tiles.join(counts, "tile", "left")
    return joined.select("tile", F.col("value").alias("field_id"), "pixel_count", F.when(F.col("value").isNotNull(), F.concat_ws("_", "tile", "value")).alias("primary_key"), F.when(F.col("value").isNull(), "missing_raster").otherwise("ok").alias("status"))


def tile_mukeys(pixels: DataFrame) -> DataFrame:
    """Distinct (tile, mukey) and how many a tile has."""
    pairs = pixels.select("tile", F.col("value").alias("mukey")).where("mukey > 0").distinct()
    return pairs.join(pairs.groupBy("tile").agg(F.count(F.lit(1)).alias("mukeys")), "tile")


def overlap_pct(pairs: DataFrame, areas: DataFrame, cell_area: float, key: str) -> DataFrame:
    """Overlap area and percent of the polygon's area (which may pass 100) from cell counts."""
    done = pairs.join(areas, key)
    return done.select(key, "mukey", (F.col("cells") * cell_area).alias("overlap_area"), F.try_divide(100 * F.col("cells") * cell_area, F.nullif(F.col("area"), F.lit(0.0))).alias("pct_overlap"))


def vpd_pivot(monthly: DataFrame, months: tuple[int, ...] = (7, 8)) -> DataFrame:
    """One row per field and year with vpdmax_<month> columns; of rows for the same month the last in (source, line) order counts."""
    year, month = year_month(F.col("day"))
    rows = monthly.select("tile_coord", "field_id", year.cast("int").alias("year"), month.alias("month"), F.coalesce("vpdmax_mean", "vpdmax_max").alias("value"), "source", "line").where(F.col("month").isin(*months) & F.col("value").isNotNull())
    last = lambda m: F.max_by(F.when(F.col("month") == m, F.col("value")), F.when(F.col("month") == m, F.struct("source", "line"))).alias(f"vpdmax_{m}")
    return rows.groupBy("tile_coord", "field_id", "year").agg(*map(last, months))
