"""Readers, catalogues and sinks."""

from __future__ import annotations

import re
import uuid
from collections.abc import Callable

import pyarrow.fs as pafs
from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from terrasheaf.functions.keys import blank_to_null, tile_from_text
from terrasheaf.operators.quality import observed
from terrasheaf.operators.stats import cumulative

POINT = T.StructType([T.StructField("x", T.DoubleType()), T.StructField("y", T.DoubleType())])


def require_columns(df: DataFrame, columns: list[str]) -> DataFrame:
    """The table itself, or an error that names the columns it lacks."""
    have = {c.lower() for c in df.columns}
    missing = [c for c in columns if c.lower() not in have]
    if missing:
        raise ValueError(f"missing columns: {', '.join(missing)}")
    return df


def read_text_table(spark: SparkSession, paths: str | list[str], required: list[str] | tuple[str, ...] = ()) -> DataFrame:
    """CSV with a header, all columns text and blanks null; a byte order mark is skipped; an empty file or a missing column is an error."""
    df = spark.read.csv(paths, header=True, inferSchema=False, encoding="UTF-8", escape='"', multiLine=False)
    if not df.columns:
        raise ValueError("no header")
    return require_columns(df.select(*(blank_to_null(F.col(f"`{c}`")).alias(c.lstrip("﻿").strip()) for c in df.columns)), list(required))


def expand_globs(spark: SparkSession, patterns: str, name: str = "*") -> list[str]:
    """The files that comma- or semicolon-separated patterns match, below folders too: by pattern in the given order and then by path, once
    each in any case. ``name`` is a pattern for file names; a pattern without files adds none. Only the listing is read."""
    found: dict[str, str] = {}
    for pattern in filter(None, map(str.strip, re.split("[,;]", patterns))):
        try:
            files = file_catalog(spark, pattern, name).select("path").orderBy("path").collect()  # a reader's list of paths is on the driver
        except AnalysisException as e:
            if e.getCondition() != "PATH_NOT_FOUND":
                raise
            files = []
        for r in files:
            found.setdefault(r["path"].lower(), r["path"])
    return list(found.values())


def union_parts(parts: list[DataFrame]) -> DataFrame:
    """Parts in one table by column name; columns that a part lacks are null there."""
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part, allowMissingColumns=True)
    return out


def read_pixels(pixels: DataFrame, grids: DataFrame) -> DataFrame:
    """A pixel table without the cells that hold their grid's nodata value."""
    small = grids.select("tile", "nodata")
    return pixels.join(small, "tile").where(F.col("value").isNotNull() & ~F.col("value").eqNullSafe(F.col("nodata"))).drop("nodata")


def read_features(spark: SparkSession, paths: str | list[str], properties: T.StructType, require_crs: bool = True) -> DataFrame:
    """Newline GeoJSON features: properties, crs and the outer ring; features without one are dropped; no feature or no CRS is an error."""
    geometry = T.StructType([T.StructField("type", T.StringType()), T.StructField("coordinates", T.ArrayType(T.ArrayType(T.ArrayType(T.DoubleType()))))])
    schema = T.StructType([T.StructField("properties", properties), T.StructField("geometry", geometry), T.StructField("crs", T.StringType())])
    df = spark.read.schema(schema).json(paths)
    outer = F.try_element_at(F.col("geometry.coordinates"), F.lit(1))
    ring = F.transform(outer, lambda p: F.struct(F.element_at(p, 1).alias("x"), F.element_at(p, 2).alias("y")))
    rows = df.select("properties.*", "crs", ring.alias("ring")).where(F.size("ring") >= 4)
    if rows.isEmpty():
        raise ValueError("no features")
    if require_crs:  # found out by the job that reads the features
        rows = rows.where(F.when(F.col("crs").isNull(), F.raise_error("a feature has no CRS").cast("boolean")).otherwise(F.lit(True)))
    return rows


def combine_features(spark: SparkSession, paths: str | list[str], properties: T.StructType) -> DataFrame:
    """Features of many files, with the name of each one's file as source_name."""
    schema = T.StructType([T.StructField("properties", properties), T.StructField("crs", T.StringType())])
    df = spark.read.schema(schema).json(paths)
    return df.select("properties.*", "crs", F.regexp_replace(F.col("_metadata.file_name"), r"\.[^.]*$", "").alias("source_name"))


def focal_from_path(spark: SparkSession, root: str) -> DataFrame:
    """Rows of one folder per focal county, with the county taken from the path."""
    df = spark.read.option("basePath", root).option("recursiveFileLookup", "true").parquet(root)
    found = F.regexp_extract(F.col("_metadata.file_path"), r"focal_fips(?:=|%3D)?_?([0-9A-Za-z]+)/[^/]*$", 1)
    return df.select("*", F.nullif(found, F.lit("")).alias("focal_fips"))


def staged(path: str, write: Callable[[str], None]) -> None:
    """A delivery that is whole or not made: ``write`` fills a folder beside ``path``, which then takes its place by renaming; what was there goes
    last. If writing fails, or the renaming, the old delivery is as it was."""
    fs, place = pafs.FileSystem.from_uri(path)
    place, mark = place.rstrip("/"), uuid.uuid4().hex
    draft, old = f"{place}.draft-{mark}", f"{place}.old-{mark}"
    exists = lambda p: fs.get_file_info(p).type != pafs.FileType.NotFound
    try:
        write(f"{path.rstrip('/')}.draft-{mark}")
    except BaseException:
        if exists(draft):
            fs.delete_dir(draft)
        raise
    there = exists(place)
    if there:
        fs.move(place, old)
    try:
        fs.move(draft, place)
    except BaseException:
        if there:
            fs.move(old, place)
        raise
    if there:
        fs.delete_dir(old)


def write_neighborhoods(df: DataFrame, path: str) -> None:
    """One folder for each focal county that has rows, as a staged delivery. Partitions are evened out before, so a hot county is spread over
    several files."""
    staged(path, lambda draft: df.hint("rebalance", "focal_fips").write.partitionBy("focal_fips").parquet(draft))


def replace_neighborhoods(df: DataFrame, path: str) -> None:
    """Puts the counties of ``df`` in the place of what a delivery has of them; its other counties stay as they are."""
    df.hint("rebalance", "focal_fips").write.partitionBy("focal_fips").mode("overwrite").option("partitionOverwriteMode", "dynamic").parquet(path)


def write_field_tables(field: DataFrame, boundary: DataFrame, path: str) -> dict[str, int]:
    """Both tables as Parquet, and as CSV without geometry, in one staged delivery. Returns how many rows each has, counted while they are
    written."""
    rows = {}

    def write(draft: str) -> None:
        for name, df in (("field", field), ("field_boundary", boundary)):
            watched, seen = observed(df, {})
            watched.write.parquet(f"{draft}/{name}.parquet")
            df.sparkSession.read.schema(df.schema).parquet(f"{draft}/{name}.parquet").drop("ring", "geometry").write.csv(f"{draft}/{name}.csv", header=True)
            rows[name] = seen.get["rows"]

    staged(path, write)
    return rows


def feature_json(df: DataFrame, properties: list[str]) -> Column:
    """One GeoJSON feature; null properties are left out."""
    ring = F.transform("ring", lambda p: F.array(p["x"], p["y"]))
    geometry = F.struct(F.lit("Polygon").alias("type"), F.array(ring).alias("coordinates"))
    return F.to_json(F.struct(F.lit("Feature").alias("type"), F.struct(*properties).alias("properties"), geometry.alias("geometry"), *(["crs"] if "crs" in df.columns else [])))


def with_feature_keys(df: DataFrame) -> DataFrame:
    """Backfills tile_id, tile_field_id and primary_key; a field id of digits becomes a number."""
    tile = F.coalesce(*(tile_from_text(F.col(c)) for c in ("tile_id", "tile_coord", "tile_field_id") if c in df.columns))
    field = F.coalesce(blank_to_null(F.col("field_id").cast("string")), F.element_at(F.split(F.col("tile_field_id"), "_", 2), -1))
    key = F.concat_ws("_", tile, field)
    return df.withColumns({"tile_id": tile, "tile_field_id": key, "primary_key": key, "field_id": F.when(field.rlike(r"^\d+$"), field).try_cast("long")})


def export_features_ndjson(features: DataFrame, path: str) -> None:
    df = with_feature_keys(features)
    names = [c for c in ("tile_field_id", "primary_key", "tile_id", "field_id", "source_name") if c in df.columns]
    df.select(feature_json(df, names).alias("value")).write.mode("overwrite").text(path)


def export_tile_features(features: DataFrame, path: str, preferred: list[str]) -> None:
    """Features in a folder for each tile, preferred columns first and all others after; a hot tile is spread over several files."""
    rest = [c for c in features.columns if c not in (*preferred, "ring", "crs", "tile_id")]
    names = [c for c in preferred if c in features.columns] + rest
    features.select("tile_id", feature_json(features, names).alias("value")).hint("rebalance", "tile_id").write.mode("overwrite").partitionBy("tile_id").text(path)


def register_parquet_view(spark: SparkSession, name: str, uri: str) -> DataFrame:
    """A view over Parquet files whose schemas are joined by name; gcs:// addresses are spelled gs://."""
    df = spark.read.option("mergeSchema", "true").parquet(re.sub("^gcs://", "gs://", uri))
    df.createOrReplaceTempView(name)
    return df


def file_catalog(spark: SparkSession, root: str, glob: str = "*") -> DataFrame:
    """Path, size and time of files below a folder; their contents are not read."""
    return spark.read.format("binaryFile").option("pathGlobFilter", glob).option("recursiveFileLookup", "true").load(root).select("path", "length", "modificationTime")


def raster_catalog(paths: DataFrame, first_year: int | None = None, last_year: int | None = None, months: list[int] | None = None) -> DataFrame:
    """Year and month parsed from file names (column path), within a span of years and a set of months."""
    digits = F.regexp_extract("path", r"(?:^|[^0-9])((?:19|20)\d{2})(0[1-9]|1[0-2])?(?:[^0-9]|$)", 1)
    month = F.regexp_extract("path", r"(?:^|[^0-9])((?:19|20)\d{2})(0[1-9]|1[0-2])?(?:[^0-9]|$)", 2)
    rows = paths.select("*", digits.try_cast("int").alias("year"), month.try_cast("int").alias("month")).where("year IS NOT NULL")
    if first_year is not None:
        rows = rows.where(F.col("year") >= first_year)
    if last_year is not None:
        rows = rows.where(F.col("year") <= last_year)
    return rows.where(F.col("month").isin(months)) if months else rows


def latest_snapshot(files: DataFrame, group: list[str] | None = None) -> DataFrame:
    """The newest file (of each group) of a catalogue; no files give an empty table. Equal times go to the last path."""
    newest = files.groupBy(*(group or [])).agg(F.max_by(F.struct(*files.columns), F.struct("modificationTime", "path")).alias("f"))
    return newest.where("f IS NOT NULL").select("f.*")


def unpack_soil_payload(payloads: DataFrame, column: str = "payload") -> DataFrame:
    """(payload_id, row, values): the rows of {"Table": [[names], [values], ...]} payloads, or of lists of objects, as maps from name to text."""
    tables = F.coalesce(*(F.from_json(F.get_json_object(column, f"$.{k}"), "array<array<string>>") for k in ("Table", "Table1", "Rows", "Data")))
    objects = F.from_json(column, "array<map<string,string>>")
    header = F.element_at(tables, 1)
    from_table = F.transform(F.slice(tables, F.lit(2), F.greatest(F.size(tables) - 1, F.lit(0))), lambda r: F.map_from_arrays(F.transform(header, F.lower), r))
    rows = F.when(tables.isNotNull(), from_table).otherwise(F.transform(objects, lambda m: F.transform_keys(m, lambda k, v: F.lower(k))))
    return payloads.select("payload_id", F.posexplode(rows).alias("row", "values"))


def mukey_worklist(pairs: DataFrame, chunk: int = 500) -> DataFrame:
    """Distinct (numeric) keys in batches of ``chunk``, in their order; a key's number is how many smaller ones there are."""
    keys = pairs.select("mukey").where("mukey IS NOT NULL").distinct()
    return cumulative(keys, [], "mukey").select("mukey", F.floor(F.col("before") / chunk).cast("long").alias("batch"))


def read_tiles(lines: DataFrame, columns: list[str] | None = None) -> DataFrame:
    """Distinct tiles of a table: of tile_id or tile_coord, else of the first column, else of any column that names one."""
    names = columns or [c for c in lines.columns if c.lower() in ("tile_id", "tile_coord")] or lines.columns
    tile = F.coalesce(*(tile_from_text(F.col(c).cast("string")) for c in names))
    return lines.select(tile.alias("tile")).where("tile IS NOT NULL").distinct()


def first_raster(catalog: DataFrame) -> DataFrame:
    """Per tile the first file by name that is no side-car."""
    side = F.lower("path").rlike(r"\.(aux|hdr|xml|ovr|prj|tfw|json|txt)$|\.aux\.xml$")
    tile = tile_from_text(F.col("path"))
    return catalog.where(~side).select("*", tile.alias("tile")).where("tile IS NOT NULL").groupBy("tile").agg(F.min("path").alias("path"))


def canonical_order(df: DataFrame, keys: list[str]) -> DataFrame:
    """Rows in the order of their key, for a sink."""
    return df.orderBy(*keys)


def row_limit(df: DataFrame, n: int, keys: list[str]) -> DataFrame:
    """The first ``n`` rows in the order of a key."""
    return df.orderBy(*keys).limit(n)
