"""Field and soil map unit overlaps, and weighted soil values."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

VALUES = ["nccpi3all", "nccpi3corn", "nccpi3soy"]


def nest_by_field(df: DataFrame, field: str, key: str, pct: str, area: str) -> DataFrame:
    """Per field: its sorted keys, maps from key to percent and to area, and their number."""
    entries = F.sort_array(F.collect_list(F.struct(F.col(key).alias("k"), F.col(pct).alias("p"), F.col(area).alias("a"))))
    rows = df.groupBy(field).agg(entries.alias("e"))
    pair = lambda n: F.map_from_entries(F.transform("e", lambda x: F.struct(x["k"], x[n])))
    return rows.select(field, F.transform("e", lambda x: x["k"]).alias("mukeys"), pair("p").alias("pct_by_mukey"), pair("a").alias("area_by_mukey"), F.size("e").cast("long").alias("mukey_count"))


def positive_weight(df: DataFrame, weight: str, values: list[str]) -> DataFrame:
    """Rows with a weight above 0 and some value."""
    return df.where((F.col(weight) > 0) & F.coalesce(*values).isNotNull())


def mukey_lookup(overlap: DataFrame, values: DataFrame) -> DataFrame:
    """Overlap rows with their soil values; rows without a match go."""
    return overlap.join(values, "mukey")


def unmatched_mukeys(overlap: DataFrame, values: DataFrame) -> DataFrame:
    return overlap.join(values, "mukey", "left_anti").agg(F.count(F.lit(1)).alias("unmatched_rows"), F.count_distinct("mukey").alias("unmatched_mukeys"))


def weighted_means(df: DataFrame, key: str, weight: str, values: list[str], digits: int = 6) -> DataFrame:
    """Σ w·v / Σ w per key, with the weights of each value column where that value is there; keys without any value are left out."""
    w = F.when(F.col(weight) > 0, F.col(weight))
    means = [F.round(F.try_divide(F.sum(w * F.col(v)), F.nullif(F.sum(F.when(F.col(v).isNotNull(), w)), F.lit(0.0))), digits).alias(v) for v in values]
    return df.groupBy(key).agg(*means).where(F.coalesce(*values).isNotNull())


def valu1_extract(staged: DataFrame, state: str) -> DataFrame:
    """Soil values of one state, tagged with its code."""
    return staged.where(F.col("mukey").isNotNull()).select(F.lit(state).alias("state_code"), "mukey", *VALUES)


def dominant_mukey(overlap: DataFrame, field: str) -> DataFrame:
    """Per field the unit with the largest overlap; ties: the lowest key."""
    return overlap.groupBy(field).agg(F.min_by(F.struct("mukey", "overlap_area"), F.struct(-F.col("overlap_area"), "mukey")).alias("d")).select(field, "d.*")


def consistent_lookup(values: DataFrame, key: str, columns: list[str]) -> DataFrame:
    """One row per key; repeats have to agree, else it is an error."""
    rows = values.groupBy(key).agg(F.count(F.lit(1)).alias("repeats"), *(F.min(c).alias(c) for c in columns), *(F.max(c).alias(f"__{c}") for c in columns))
    agree = F.lit(True)
    for c in columns:
        agree = agree & F.col(c).eqNullSafe(F.col(f"__{c}"))
    checked = F.when(agree, F.col("repeats")).otherwise(F.raise_error(F.concat(F.lit("conflicting values for "), F.col(key).cast("string"))).cast("long"))
    return rows.select(key, *columns, checked.alias("repeats"))
