"""Joining field-year tables, with a report of what each join loses."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

FIELD_YEAR = ["tile_field_ID", "year"]


def year_range(df: DataFrame, start: int | None = None, end: int | None = None, column: str = "year") -> DataFrame:
    """Rows of the years from start to end; a year that is no integer drops the row."""
    year = F.trim(F.col(column).cast("string")).try_cast("int")
    rows = df.withColumn(column, year).where(F.col(column).isNotNull())
    if start is not None:
        rows = rows.where(F.col(column) >= start)
    return rows if end is None else rows.where(F.col(column) <= end)


def na_coverage(df: DataFrame, keys: list[str], value: str, share: str = "pct_na_all", limit: float = 0.9) -> DataFrame:
    """Rows with keys and value whose missing share is at most ``limit``; an unknown share passes."""
    return df.dropna(subset=[*keys, value]).where(F.coalesce(F.col(share) <= limit, F.lit(True)))


def required_values(df: DataFrame, columns: list[str]) -> DataFrame:
    return df.dropna(subset=columns)


def dropped_rows(df: DataFrame, columns: list[str]) -> DataFrame:
    """How many rows lack one of the columns at least."""
    full = F.lit(True)
    for c in columns:
        full = full & F.col(c).isNotNull()
    return df.agg(F.count(F.lit(1)).alias("rows"), F.count_if(~full).alias("dropped"))


def covariate_join(corn: DataFrame, tillage: DataFrame, vpd: DataFrame, soil: DataFrame, county: DataFrame) -> DataFrame:
    """Corn with tillage and climate of its field and year, and soil and county of its field; rows without one of them go."""
    return corn.join(tillage, FIELD_YEAR).join(vpd, FIELD_YEAR).join(soil, "tile_field_ID").join(county, "tile_field_ID")


def copartitioned_join(corn: DataFrame, tillage: DataFrame, vpd: DataFrame, soil: DataFrame, county: DataFrame) -> DataFrame:
    """``covariate_join`` of tables that lie in as many buckets of the field each (``runtime.bucketed``): no table is shuffled.

    Spark reuses such buckets only for joins on the field alone, so years are compared in the condition, of which a field has a few dozen."""

    def in_year(left: DataFrame, right: DataFrame) -> DataFrame:
        same = (F.col("l.tile_field_ID") == F.col("r.tile_field_ID")) & (F.col("l.year") - F.col("r.year") == 0)
        return left.alias("l").join(right.alias("r"), same).select("l.*", *(f"r.{c}" for c in right.columns if c not in FIELD_YEAR))

    return in_year(in_year(corn, tillage), vpd).join(soil, "tile_field_ID").join(county, "tile_field_ID")


def coverage_funnel(corn: DataFrame, tillage: DataFrame, vpd: DataFrame, soil: DataFrame, county: DataFrame) -> DataFrame:
    """One row: corn rows, how many are lost at each join in turn, and how many are left."""
    mark = lambda df, keys, name: df.select(*keys).distinct().withColumn(name, F.lit(True))
    rows = corn.select(*FIELD_YEAR).join(mark(tillage, FIELD_YEAR, "t"), FIELD_YEAR, "left").join(mark(vpd, FIELD_YEAR, "v"), FIELD_YEAR, "left")
    rows = rows.join(mark(soil, ["tile_field_ID"], "s"), "tile_field_ID", "left").join(mark(county, ["tile_field_ID"], "c"), "tile_field_ID", "left")
    has = {n: F.col(n).isNotNull() for n in "tvsc"}
    return rows.agg(
        F.count(F.lit(1)).alias("corn_rows"),
        F.count_if(~has["t"]).alias("missing_tillage"),
        F.count_if(has["t"] & ~has["v"]).alias("missing_vpd"),
        F.count_if(has["t"] & has["v"] & ~has["s"]).alias("missing_soil"),
        F.count_if(has["t"] & has["v"] & has["s"] & ~has["c"]).alias("missing_county"),
        F.count_if(has["t"] & has["v"] & has["s"] & has["c"]).alias("joined_rows"),
    )


def merge_field_year(corn: DataFrame, tillage: DataFrame, soy: DataFrame) -> DataFrame:
    """All keys of three tables, with what each knows of them."""
    return corn.join(tillage, FIELD_YEAR, "full").join(soy, FIELD_YEAR, "full")


def key_union(frames: list[DataFrame], keys: list[str]) -> DataFrame:
    out = frames[0].select(*keys)
    for frame in frames[1:]:
        out = out.unionByName(frame.select(*keys))
    return out.distinct()


def last_write_wins(df: DataFrame, keys: list[str], order: list[str]) -> DataFrame:
    """Per key the row that comes last in an explicit order."""
    rest = [c for c in df.columns if c not in keys]
    return df.groupBy(*keys).agg(F.max_by(F.struct(*rest), F.struct(*order)).alias("r")).select(*keys, "r.*")


def field_covariates(index: DataFrame, crop: DataFrame, soil: DataFrame, climate: DataFrame) -> DataFrame:
    """Every field of an index with its crop years, and soil and climate where known."""
    return index.join(crop, "tile_field_ID", "left").join(soil, "tile_field_ID", "left").join(climate, FIELD_YEAR, "left")
