"""Queries: readers, sinks, catalogues and the column functions for keys and messy values."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from terrasheaf.functions import keys as K
from terrasheaf.functions.keys import tile_from_text
from terrasheaf.operators import cropyear as Y
from terrasheaf.operators import fields as B
from terrasheaf.plans.assembly import hood
from terrasheaf.plans.grids import RING_HASHES, features, rings
from terrasheaf.plans.registry import query, uuid_sql
from terrasheaf.plans.standins import Tables
from terrasheaf.runtime import scratch_path, stored
from terrasheaf.sources import tables as R


@query("SELECT CAST(c_custkey AS VARCHAR) AS c_custkey, nullif(trim(raw_id), '') AS raw_id, nullif(trim(raw_month), '') AS raw_month FROM {messy}")
def A1_read_text_table(t: Tables) -> DataFrame:
    path = scratch_path(t.spark, "messy-csv")
    t.messy.select(F.col("c_custkey").cast("string").alias("c_custkey"), "raw_id", "raw_month").write.csv(path, header=True)
    return R.read_text_table(t.spark, path, ["c_custkey", "raw_id"])


@query("SELECT tile_field_ID, year FROM {corn}")
def A2_expand_globs(t: Tables) -> DataFrame:
    path = scratch_path(t.spark, "corn-years")
    t.corn.select("tile_field_ID", "year", F.col("year").alias("y")).write.partitionBy("y").parquet(path)
    files = R.expand_globs(t.spark, f"{path}/y=199*; {path}/y=1995, {path}/y=20*,{path}/y=18*, {path}", "*.parquet")  # they overlap, and one has none
    return t.spark.read.parquet(*files).select("tile_field_ID", "year")


@query(
    "SELECT tile_field_ID, year, unscaled_yield, CAST(NULL AS INT) AS annual_tillage FROM {corn} UNION ALL SELECT tile_field_ID, year, NULL, "
    "annual_tillage FROM {tillage}"
)
def A3_union_parts(t: Tables) -> DataFrame:
    return R.union_parts([t.corn.select("tile_field_ID", "year", "unscaled_yield"), t.tillage.select("tile_field_ID", "year", "annual_tillage")])


PROPERTIES = T.StructType([T.StructField("tile_id", T.StringType()), T.StructField("field_id", T.LongType()), T.StructField("tile_field_id", T.StringType()), T.StructField("primary_key", T.StringType())])


def exported(t: Tables) -> str:
    path = scratch_path(t.spark, "features")
    df = rings(t).select(F.col("tile").alias("tile_id"), F.col("field_id").cast("string").alias("field_id"), F.lit(None).cast("string").alias("tile_field_id"), "ring", F.lit("EPSG:5070").alias("crs"))
    R.export_features_ndjson(df, path)
    return path


@query(
    "SELECT tile AS tile_id, field_id, concat(tile, '_', CAST(field_id AS VARCHAR)) AS tile_field_id, CASE WHEN shape = 2 THEN 4 ELSE 5 END AS points "
    "FROM {ring_boxes}"
)
def A5_read_features(t: Tables) -> DataFrame:
    return R.read_features(t.spark, exported(t), PROPERTIES).select("tile_id", "field_id", "tile_field_id", F.size("ring").alias("points"))


@query("SELECT tile AS tile_id, field_id, 'part' AS source_kind FROM {ring_boxes}")
def A6_combine_features(t: Tables) -> DataFrame:
    rows = R.combine_features(t.spark, exported(t), PROPERTIES)
    return rows.select("tile_id", "field_id", F.substring_index("source_name", "-", 1).alias("source_kind"))


@query("SELECT focal_fips, tile_field_ID, year, unscaled_yield FROM {hood}")
def A7_focal_from_path(t: Tables) -> DataFrame:
    path = scratch_path(t.spark, "neighborhoods")
    R.write_neighborhoods(hood(t), path)
    return R.focal_from_path(t.spark, path).select("focal_fips", "tile_field_ID", "year", "unscaled_yield")


@query("SELECT focal_fips, tile_field_ID, year FROM {hood}")
def A8_write_neighborhoods(t: Tables) -> DataFrame:
    path = scratch_path(t.spark, "neighborhoods")
    R.write_neighborhoods(hood(t).select("focal_fips", "tile_field_ID", "year"), path)
    schema = "tile_field_ID string, year int, focal_fips string"
    return t.spark.read.schema(schema).parquet(path).select("focal_fips", "tile_field_ID", "year")


@query(
    "SELECT tile AS tile_coord, CAST(field_id AS VARCHAR) AS source_field_id, CAST(CASE WHEN field_id % 4 = 0 THEN 2 ELSE 1 END AS BIGINT) AS boundaries, "
    "CASE WHEN field_id % 4 = 0 THEN '2' ELSE '1' END AS boundary_count FROM {ring_boxes} WHERE field_id % 13 <> 0"
)
def A9_write_field_tables(t: Tables) -> DataFrame:
    path = scratch_path(t.spark, "field-tables")
    boundary = B.field_boundaries(features(t), "src", "30m")
    R.write_field_tables(B.field_index(boundary), boundary, path)
    keys = ["tile_coord", "source_field_id"]
    rows = t.spark.read.parquet(f"{path}/field_boundary.parquet").groupBy(*keys).agg(F.count(F.lit(1)).alias("boundaries"))
    return t.spark.read.csv(f"{path}/field.csv", header=True).select(*keys, "boundary_count").join(rows, keys)


@query(
    "SELECT tile AS tile_id, CAST(field_id AS VARCHAR) AS field_id, concat(tile, '_', CAST(field_id AS VARCHAR)) AS primary_key, 'Feature' AS type, CASE "
    "WHEN shape = 2 THEN 4 ELSE 5 END AS points FROM {ring_boxes}"
)
def A10_export_features_ndjson(t: Tables) -> DataFrame:
    lines = t.spark.read.text(exported(t))
    of = lambda path: F.get_json_object("value", f"$.{path}")
    points = F.size(F.from_json(of("geometry.coordinates"), "array<array<array<double>>>")[0])
    return lines.select(*(of(f"properties.{c}").alias(c) for c in ("tile_id", "field_id", "primary_key")), of("type").alias("type"), points.alias("points"))


@query("SELECT tile AS tile_id, CAST(field_id AS VARCHAR) AS field_id, 's' AS source_name FROM {ring_boxes}")
def A11_export_tile_features(t: Tables) -> DataFrame:
    path = scratch_path(t.spark, "tile-features")
    R.export_tile_features(rings(t).select(F.col("tile").alias("tile_id"), "field_id", F.lit("s").alias("source_name"), "ring", F.lit("EPSG:5070").alias("crs")), path, ["field_id"])
    return t.spark.read.text(path).select("tile_id", *(F.get_json_object("value", f"$.properties.{c}").alias(c) for c in ("field_id", "source_name")))


@query("SELECT tile_field_ID, year, CAST(NULL AS VARCHAR) AS FIPS FROM {corn} UNION ALL SELECT tile_field_ID, NULL, FIPS FROM {keys}")
def A12_register_parquet_view(t: Tables) -> DataFrame:
    path = scratch_path(t.spark, "view")
    t.corn.select("tile_field_ID", "year").write.parquet(f"{path}/part=a")
    t.keys.select("tile_field_ID", "FIPS").write.parquet(f"{path}/part=b")
    R.register_parquet_view(t.spark, "terrasheaf_view", path)
    return t.spark.sql("SELECT tile_field_ID, year, FIPS FROM terrasheaf_view")


PATHS = "concat('/r/', tile_coord, '/vpd_', CAST(year AS STRING), lpad(CAST(month AS STRING), 2, '0'), CASE WHEN l_linenumber = 1 THEN '.tif' ELSE '.tif.aux.xml' END)"


def paths(t: Tables) -> DataFrame:
    return t.lines.select(F.expr(PATHS).alias("path")).distinct()


@query("SELECT DISTINCT year, month FROM {lines} WHERE year BETWEEN 1997 AND 1999 AND month IN (7, 8)")
def A13_file_catalog(t: Tables) -> DataFrame:
    root = scratch_path(t.spark, "rasters")
    cells = t.lines.select(F.expr("concat('vpd_', CAST(year AS STRING), lpad(CAST(month AS STRING), 2, '0'))").alias("name"), "l_quantity")
    cells.repartition("name").write.partitionBy("name").csv(root)
    files = R.file_catalog(t.spark, root, "*.csv").select(F.regexp_extract("path", "(name=[^/]*)/[^/]*$", 1).alias("path"))
    return R.raster_catalog(files, 1997, 1999, [7, 8]).select("year", "month")


@query("SELECT tile_coord, arg_max(field_ID, (l_shipdate, field_ID)) AS path FROM {lines} GROUP BY 1")
def A14_latest_snapshot(t: Tables) -> DataFrame:
    files = t.lines.select("tile_coord", F.col("field_ID").alias("path"), F.col("l_shipdate").alias("modificationTime"))
    return R.latest_snapshot(files, ["tile_coord"]).select("tile_coord", "path")


@query("SELECT p_brand AS payload_id, CAST(count(*) AS BIGINT) AS rows, CAST(sum(p_size) AS BIGINT) AS size FROM {part} GROUP BY 1")
def A15_unpack_soil_payload(t: Tables) -> DataFrame:
    rows = F.collect_list(F.array(F.col("p_partkey").cast("string"), F.col("p_size").cast("string")))  # of 500 keys, as a service answers
    table = F.to_json(F.struct(F.concat(F.array(F.array(F.lit("mukey"), F.lit("NCCPI"))), rows).alias("Table")))
    payloads = t.part.groupBy(F.col("p_brand").alias("payload_id"), F.floor(F.col("p_partkey") / 500)).agg(table.alias("payload"))
    found = R.unpack_soil_payload(payloads)
    return found.groupBy("payload_id").agg(F.count("values.mukey").alias("rows"), F.sum(F.col("values.nccpi").cast("long")).alias("size"))


@query(
    "SELECT CAST(mukey AS BIGINT) AS mukey, CAST(floor((row_number() OVER (ORDER BY mukey) - 1) / 500.0) AS BIGINT) AS batch FROM (SELECT DISTINCT mukey "
    "FROM {field_mukey})"
)
def A16_mukey_worklist(t: Tables) -> DataFrame:
    return R.mukey_worklist(t.field_mukey)


@query("SELECT DISTINCT lower(regexp_extract(raw_tile, '(?i)(h\\d\\dv\\d\\d)', 1)) AS tile FROM {messy} WHERE regexp_matches(raw_tile, '(?i)h\\d\\dv\\d\\d')")
def A17_read_tiles(t: Tables) -> DataFrame:
    return R.read_tiles(t.messy.select(F.col("raw_tile").alias("tile_id")))


@query("SELECT tile_field_ID, year, unscaled_yield FROM {corn}")
def G1_canonical_order(t: Tables) -> DataFrame:
    return R.canonical_order(t.corn.select("tile_field_ID", "year", "unscaled_yield"), ["tile_field_ID", "year"])


@query("SELECT tile_field_ID, year FROM {corn} ORDER BY tile_field_ID, year LIMIT 100")
def G4_row_limit(t: Tables) -> DataFrame:
    return R.row_limit(t.corn.select("tile_field_ID", "year"), 100, ["tile_field_ID", "year"])


@query(f"SELECT tile_coord AS tile, min({PATHS}) AS path FROM {{lines}} WHERE l_linenumber = 1 GROUP BY 1")
def G5_first_raster(t: Tables) -> DataFrame:
    return R.first_raster(paths(t))


@query("SELECT tile_field_ID, year, unscaled_yield FROM {corn}")
def I1_require_columns(t: Tables) -> DataFrame:
    return R.require_columns(t.corn, ["tile_field_ID", "YEAR"]).select("tile_field_ID", "year", "unscaled_yield")


# a later run, in which 1997 has changed and 1995 is missing, against the manifest of an earlier one
@query(
    "SELECT tile_coord AS tile, year, CASE WHEN year <> 1995 THEN count(*) END AS rows, CASE WHEN year <> 1995 THEN CAST(octet_length(encode(string_agg("
    "line, '' ORDER BY line))) AS BIGINT) END AS bytes, CASE WHEN year <> 1995 THEN sha256(string_agg(line, '' ORDER BY line)) END AS sha256, year NOT IN (1995, 1997) AS hash_matches "
    "FROM (SELECT tile_coord, year, concat(tile_field_ID, ',', CAST(pixel_count + CASE WHEN year = 1997 THEN 1 ELSE 0 END AS VARCHAR), chr(10)) AS line FROM {corn}) GROUP BY 1, 2"
)
def I6_delivery_manifest(t: Tables) -> DataFrame:
    def delivered(rows: DataFrame) -> tuple[DataFrame, DataFrame]:
        path = scratch_path(t.spark, "delivery")
        lines = rows.select("tile_coord", "year", F.concat_ws(",", "tile_field_ID", "pixel_count").alias("value"))
        lines = lines.repartition("tile_coord", "year").sortWithinPartitions("tile_coord", "year", "value")
        R.staged(path, lambda draft: lines.write.partitionBy("tile_coord", "year").text(draft))
        files = t.spark.read.format("binaryFile").option("pathGlobFilter", "*.txt").option("recursiveFileLookup", "true").load(path)
        counted = t.spark.read.option("recursiveFileLookup", "true").text(path).select(F.col("_metadata.file_path").alias("path"))
        return Y.in_delivery(files), Y.in_delivery(counted)

    earlier = stored(Y.delivery_manifest(*delivered(t.corn)), "manifest")
    later = t.corn.where("year <> 1995").withColumn("pixel_count", F.col("pixel_count") + (F.col("year") == 1997).cast("int"))
    found = Y.delivery_manifest(*delivered(later), earlier)
    return found.select(tile_from_text(F.col("path")).alias("tile"), F.regexp_extract("path", "year=([0-9]+)", 1).cast("int").alias("year"), "rows", "bytes", "sha256", "hash_matches")


@query("SELECT c_custkey, nullif(trim(raw_id), '') AS id FROM {messy}")
def B1_blank_to_null(t: Tables) -> DataFrame:
    return t.messy.select("c_custkey", K.blank_to_null(F.col("raw_id")).alias("id"))


TILE = "nullif(lower(regexp_extract({0}, '(?i)(h\\d\\dv\\d\\d)', 1)), '')"


@query(f"SELECT c_custkey, {TILE.format('raw_tile')} AS tile, CASE WHEN regexp_matches(raw_tile, '(?i)^h\\d\\dv\\d\\d$') THEN lower(raw_tile) END AS exact FROM {{messy}}")
def B2_tile_from_text(t: Tables) -> DataFrame:
    c = F.col("raw_tile")
    return t.messy.select("c_custkey", K.tile_from_text(c).alias("tile"), K.tile_from_text(c, "exact").alias("exact"))


@query(f"SELECT c_custkey, CASE WHEN id LIKE '%\\_%' ESCAPE '\\' THEN id ELSE coalesce(tile || '_' || id, tile || '_' || CAST(c_custkey AS VARCHAR)) END AS tile_field_id FROM (SELECT c_custkey, nullif(trim(raw_id), '') AS id, {TILE.format('raw_tile')} AS tile FROM {{messy}})")
def B3_tile_field_id(t: Tables) -> DataFrame:
    return t.messy.select("c_custkey", K.tile_field_id([F.col("raw_id")], [F.col("raw_tile")], [F.col("c_custkey").cast("string")]).alias("tile_field_id"))


@query("SELECT tile_field_ID, tile_coord AS tile, field_ID AS field FROM {keys}")
def B4_split_tile_field_id(t: Tables) -> DataFrame:
    tile, field = K.split_tile_field_id(F.col("tile_field_ID"))
    return t.keys.select("tile_field_ID", tile.alias("tile"), field.alias("field"))


@query("SELECT c_custkey, coalesce(nullif(trim(raw_id), ''), nullif(trim(raw_month), ''), raw_tile) AS picked FROM {messy}")
def B5_pick(t: Tables) -> DataFrame:
    return t.messy.select("c_custkey", K.pick(F.col("raw_id"), F.col("raw_month"), F.col("raw_tile")).alias("picked"))


@query("SELECT c_custkey AS field, raw_tile AS tile, 'c_custkey' AS field_from, 'raw_tile' AS tile_from FROM {messy}")
def B6_alias_columns(t: Tables) -> DataFrame:
    return K.alias_columns(t.messy, {"field": ["field_id", "C_CUSTKEY"], "tile": ["tile_coord", "RAW_TILE", "raw_id"]}, report=True)


@query("SELECT c_custkey, regexp_replace(nullif(trim(raw_id), ''), '\\.0$', '') AS text, regexp_replace(nullif(trim(raw_id), ''), '^([+-]?\\d+)\\.0+$', '\\1') AS strict FROM {messy}")
def B7_normalize_id(t: Tables) -> DataFrame:
    return t.messy.select("c_custkey", K.normalize_id(F.col("raw_id")).alias("text"), K.normalize_id(F.col("raw_id"), "strict").alias("strict"))


@query(
    "SELECT c_custkey, CASE WHEN length(raw_month) = 6 AND try_cast(raw_month AS INT) IS NOT NULL THEN substr(raw_month, 1, 4) END AS year, CASE "
    "WHEN length(raw_month) = 6 AND try_cast(raw_month AS INT) IS NOT NULL THEN CAST(substr(raw_month, 5, 2) AS INT) END AS month FROM {messy}"
)
def B8_year_month(t: Tables) -> DataFrame:
    year, month = K.year_month(F.col("raw_month"))
    return t.messy.select("c_custkey", year.alias("year"), month.alias("month"))


@query("SELECT c_custkey, try_cast(raw_number AS DOUBLE) AS number, CASE WHEN try_cast(raw_number AS DOUBLE) IS NULL THEN raw_number END AS text FROM {messy}")
def B9_to_number(t: Tables) -> DataFrame:
    number, text = K.number_or_text(F.col("raw_number"))
    return t.messy.select("c_custkey", number.alias("number"), text.alias("text"))


@query("SELECT tile_field_ID, year, annual_tillage FROM {tillage}")
def B10_annual_tillage(t: Tables) -> DataFrame:
    return t.tillage.select("tile_field_ID", "year", K.annual_tillage(F.coalesce(F.col("annual_tillage").cast("string"), F.lit(" "))).alias("annual_tillage"))


@query(uuid_sql(K.FIELD_NAMESPACE, "concat('src|', tile_coord, '|', field_ID)", "tile_field_ID", "{keys}", "field_uuid"))
def B14_uuid5(t: Tables) -> DataFrame:
    return t.keys.select("tile_field_ID", K.field_uuid(F.lit("src"), F.col("tile_coord"), F.col("field_ID")).alias("field_uuid"))


BOUNDARY_ROWS = (
    f"(SELECT b.tile AS tile_coord, b.field_id AS source_field_id, s.source_name, h.geometry_hash FROM {{ring_boxes}} b "
    f"JOIN ({RING_HASHES}) h ON b.tile = h.tile AND b.field_id = h.field_id JOIN (SELECT 'a' AS source_name UNION ALL "
    "SELECT 'b') s ON s.source_name = 'a' OR b.field_id % 4 = 0 WHERE b.field_id % 13 <> 0)"
)
BOUNDARY_NAME = "concat('src|30m|2008||', tile_coord, '|', CAST(source_field_id AS VARCHAR), '|', geometry_hash)"


@query(uuid_sql(K.BOUNDARY_NAMESPACE, BOUNDARY_NAME, "tile_coord, source_field_id, source_name", BOUNDARY_ROWS, "field_boundary_id"))
def B14_boundary_uuid(t: Tables) -> DataFrame:
    rows = B.field_boundaries(features(t), "src", "30m")
    return rows.select("tile_coord", F.col("source_field_id").cast("long").alias("source_field_id"), "source_name", "field_boundary_id")


@query(
    "SELECT c_custkey, nullif(substr(regexp_replace(upper(raw_tile), '[^A-Z0-9]', '', 'g'), 1, 2), '') AS symbol, nullif(regexp_replace(upper(raw_tile), "
    "'[^A-Z0-9]', '', 'g'), '') AS code FROM {messy}"
)
def B16_state_code(t: Tables) -> DataFrame:
    return t.messy.select("c_custkey", K.state_code(F.col("raw_tile"), "areasymbol").alias("symbol"), K.state_code(F.col("raw_tile")).alias("code"))


BOUNDS = "concat(CAST(c_custkey AS STRING), ', 2,', CASE WHEN c_custkey % 3 = 0 THEN 'x' ELSE CAST(c_custkey + c_custkey % 2 AS STRING) END, ',9')"


@query("SELECT c_custkey, c_custkey % 3 <> 0 AND c_custkey % 2 = 1 AS valid FROM {messy}")
def B17_bbox_valid(t: Tables) -> DataFrame:
    return t.messy.select("c_custkey", K.bounds(F.expr(BOUNDS)).isNotNull().alias("valid"))
