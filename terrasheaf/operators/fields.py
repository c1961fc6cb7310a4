"""Field and boundary tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from terrasheaf.functions.keys import blank_to_null, boundary_uuid, field_uuid, geometry_hash


def non_missing_id(features: DataFrame) -> DataFrame:
    """Features with a field and a tile."""
    return features.where(blank_to_null(F.col("field_id").cast("string")).isNotNull() & blank_to_null(F.col("tile_coord")).isNotNull())


def field_boundaries(features: DataFrame, source: str, resolution: str) -> DataFrame:
    """Boundaries with deterministic ids of field and boundary and a hash of the geometry."""
    rows = non_missing_id(features).withColumn("geometry_hash", geometry_hash(F.col("ring")))
    field = field_uuid(F.lit(source), F.col("tile_coord"), F.col("field_id"))
    boundary = boundary_uuid(F.lit(source), F.lit(resolution), F.col("valid_start"), F.col("valid_end"), F.col("tile_coord"), F.col("field_id"), F.col("geometry_hash"))
    return rows.select(
        boundary.alias("field_boundary_id"),
        field.alias("field_id"),
        F.lit(source).alias("source"),
        "tile_coord",
        F.col("field_id").alias("source_field_id"),
        "source_name",
        "geometry_hash",
        "ring",
    )


def field_index(boundaries: DataFrame) -> DataFrame:
    """One row per field: how many boundaries it has and the distinct names of their sources."""
    return boundaries.groupBy("field_id", "source", "tile_coord", "source_field_id").agg(F.count(F.lit(1)).alias("boundary_count"), F.array_join(F.array_sort(F.collect_set("source_name")), ";").alias("source_names"))


def field_rollup_checks(features: DataFrame) -> DataFrame:
    """Rows without tile, field or id, and distinct tiles and ids."""
    blank = lambda c: F.count_if(blank_to_null(F.col(c).cast("string")).isNull())
    return features.agg(F.count(F.lit(1)).alias("rows"), blank("tile_coord").alias("missing_tile"), blank("field_id").alias("missing_field"), blank("tile_field_id").alias("missing_id"), F.count_distinct("tile_coord").alias("tiles"), F.count_distinct("tile_field_id").alias("ids"))
