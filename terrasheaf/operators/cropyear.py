"""Crop composition per field and year."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from terrasheaf.operators.grid import pixel_pair_join

ACRE_M2 = 4046.8564224


def pair_counts(fields: DataFrame, values: DataFrame, year: Column) -> DataFrame:
    """(field_id, crop_id, year, pixel_count) of cells in both tables; 0 is nodata on either side."""
    cells = pixel_pair_join(fields, values).where("field_id <> 0 AND value <> 0")
    return cells.groupBy("field_id", F.col("value").alias("crop_id"), year.alias("year")).agg(F.count(F.lit(1)).alias("pixel_count"))


def crop_year_summary(counts: DataFrame) -> DataFrame:
    """Adds a field's total, the crop's share, the dominant crop (ties: smallest id) and its share."""
    top = F.min_by(F.struct("crop_id", "pixel_count"), F.struct(-F.col("pixel_count"), "crop_id"))
    fields = counts.groupBy("field_id", "year").agg(F.sum("pixel_count").alias("total_field_pixels"), top.alias("top"))
    rows = counts.join(fields, ["field_id", "year"])
    return rows.select("field_id", "year", "crop_id", "pixel_count", "total_field_pixels", (F.col("pixel_count") / F.col("total_field_pixels")).alias("share"), (F.col("crop_id") == F.col("top.crop_id")).alias("is_dominant"), F.col("top.crop_id").alias("dominant_crop_id"), (F.col("top.pixel_count") / F.col("total_field_pixels")).alias("dominant_crop_share"))


def dominant_crop(counts: DataFrame) -> DataFrame:
    return crop_year_summary(counts).select("field_id", "year", "crop_id", "dominant_crop_id")


def share_of_field(counts: DataFrame) -> DataFrame:
    return crop_year_summary(counts).select("field_id", "year", "crop_id", "share")


def crop_units(df: DataFrame, cell_area: float, crop_codes: DataFrame) -> DataFrame:
    """Adds area in square metres and acres, and the crop's name where its code is known."""
    return df.join(crop_codes, "crop_id", "left").withColumns({"area_m2": F.col("pixel_count") * cell_area, "acres": F.col("pixel_count") * cell_area / ACRE_M2})


def validate_crop_year(counts: DataFrame, summary: DataFrame, year: int | None = None, max_id: int = 65_535) -> DataFrame:
    """One row of ten checks, each true if it holds; rows_match: the summary has the rows of the counts, with the same numbers, and no other."""
    keys = ["field_id", "year", "crop_id", "pixel_count"]
    both = counts.select(*keys, F.lit(1).alias("n")).unionByName(summary.select(*keys, F.lit(-1).alias("n")))
    match = both.groupBy(*keys).agg(F.sum("n").alias("n")).agg((F.count_if(F.col("n") != 0) == 0).alias("rows_match"))
    fields = summary.groupBy("field_id", "year").agg(F.sum("share").alias("s"), F.count_if("is_dominant").alias("d"), F.count(F.lit(1)).alias("n"), F.count_distinct("crop_id").alias("k"), F.min("year").alias("y0"), F.max("year").alias("y1"), F.min("pixel_count").alias("low"), F.min("share").alias("s0"), F.max("share").alias("s1"), F.min("crop_id").alias("c0"), F.max("crop_id").alias("c1"), F.min("field_id").alias("f0"))
    every = lambda c: F.coalesce(F.bool_and(c), F.lit(True))
    checks = fields.agg(
        (F.count(F.lit(1)) > 0).alias("non_empty"),
        every((F.col("y0") == F.lit(year)) & (F.col("y1") == F.lit(year)) if year is not None else F.col("y0").isNotNull()).alias("year_ok"),
        every(F.col("low") > 0).alias("counts_positive"),
        every((F.col("s0") >= 0) & (F.col("s1") <= 1)).alias("shares_in_range"),
        every(F.abs(F.col("s") - 1) < 1e-6).alias("shares_sum_to_one"),
        every(F.col("d") == 1).alias("one_dominant"),
        every(F.col("n") == F.col("k")).alias("rows_unique"),
        every((F.col("c0") >= 0) & (F.col("c1") <= max_id)).alias("crop_ids_in_range"),
        every(F.col("f0") > 0).alias("field_ids_positive"),
    )
    return checks.crossJoin(F.broadcast(match))


def merge_checks(parts: list[DataFrame], units: DataFrame, key: list[str]) -> DataFrame:
    """One row: rows of the merged parts, duplicate keys, work units that no part has, and rows outside the planned units."""
    merged = parts[0]
    for part in parts[1:]:
        merged = merged.unionByName(part)
    rows = merged.groupBy(*key).agg(F.count(F.lit(1)).alias("n")).agg(F.coalesce(F.sum("n"), F.lit(0)).alias("rows"), F.count_if(F.col("n") > 1).alias("duplicate_keys"))
    missing = units.join(merged.select(*units.columns).distinct(), units.columns, "left_anti").agg(F.count(F.lit(1)).alias("missing_units"))
    outside = merged.join(units, units.columns, "left_anti").agg(F.count(F.lit(1)).alias("rows_outside"))
    return rows.crossJoin(F.broadcast(missing)).crossJoin(F.broadcast(outside))


def in_delivery(files: DataFrame, column: str = "path") -> DataFrame:
    """Files of a partitioned delivery by the folders that name their partitions, which are the same in every run."""
    return files.withColumn(column, F.regexp_extract(column, "((?:/[^/=]+=[^/]*)+)/[^/]*$", 1))


def delivery_manifest(files: DataFrame, rows: DataFrame, expected: DataFrame | None = None) -> DataFrame:
    """Path, rows, bytes and SHA-256 of each delivered file (a binaryFile table; ``rows`` has one row, with the file's path, for each of a
    file's rows). Against an ``expected`` manifest also whether the hash is the expected one, with missing and unexpected files as false."""
    counted = rows.groupBy("path").agg(F.count(F.lit(1)).alias("rows"))
    found = files.select("path", F.col("length").alias("bytes"), F.sha2("content", 256).alias("sha256")).join(counted, "path", "left").fillna(0, ["rows"])
    if expected is None:
        return found.select("path", "rows", "bytes", "sha256")
    both = found.join(expected.select("path", F.col("sha256").alias("__expected")), "path", "full")
    return both.select("path", "rows", "bytes", "sha256", F.coalesce(F.col("sha256") == F.col("__expected"), F.lit(False)).alias("hash_matches"))
