"""Checks and counters."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window


def assert_unique(df: DataFrame, key: list[str]) -> DataFrame:
    """The table itself; a key that occurs twice is an error."""
    twice = df.groupBy(*key).agg(F.count(F.lit(1)).alias("n")).where("n > 1").limit(1).collect()
    if twice:
        raise ValueError(f"duplicate key {twice[0][:-1]}")
    return df


def unique_or_error(df: DataFrame, key: list[str]) -> DataFrame:
    """The table itself, checked by the job that reads it: a key that occurs twice ends that job with an error. A null is a value like others."""
    n = F.count(F.lit(1)).over(Window.partitionBy(*key))
    told = F.raise_error(F.concat(F.lit("duplicate key "), F.to_json(F.struct(*key))))
    return df.withColumn("__n", n).where(F.when(F.col("__n") > 1, told.cast("boolean")).otherwise(F.lit(True))).drop("__n")


def observed(df: DataFrame, metrics: dict[str, Column]) -> tuple[DataFrame, Observation]:
    """The table, and what will be known of it once a job has read it through: ``rows`` and how many rows each condition holds for. The figures
    come out of that job and cost no pass of their own."""
    watch = Observation()
    return df.observe(watch, F.count(F.lit(1)).alias("rows"), *(F.count_if(c).alias(n) for n, c in metrics.items())), watch


def duplicate_rows(df: DataFrame, key: list[str]) -> DataFrame:
    """Rows beyond the first of each key."""
    return df.groupBy(*key).agg(F.count(F.lit(1)).alias("n")).agg(F.coalesce(F.sum("n"), F.lit(0)).alias("rows"), F.coalesce(F.sum(F.col("n") - 1), F.lit(0)).alias("duplicate_rows"))


def job_summary(df: DataFrame, metrics: dict[str, Column]) -> DataFrame:
    """The number of rows, and of those for which each condition holds, in one pass."""
    return df.agg(F.count(F.lit(1)).alias("rows"), *(F.count_if(c).alias(n) for n, c in metrics.items()))


def read_summaries(spark: SparkSession, paths: str | list[str], counters: list[str]) -> DataFrame:
    """Summary files of tiles, JSON of one object a line: tile and counters."""
    return spark.read.schema(", ".join(["tile string", *(f"`{c}` long" for c in counters)])).json(paths)


def rollup_summaries(summaries: DataFrame, counters: list[str]) -> DataFrame:
    """Sums of the counters of many summaries, and the sorted tiles they are for."""
    return summaries.agg(*(F.sum(c).alias(c) for c in counters), F.array_join(F.array_sort(F.collect_set("tile")), ";").alias("tiles"))


def optional_missing(df: DataFrame, columns: list[str]) -> DataFrame:
    """(column, missing) for each optional column."""
    entries = F.array(*(F.struct(F.lit(c).alias("column_name"), F.nullif(F.trim(F.col(c).cast("string")), F.lit("")).isNull().alias("m")) for c in columns))
    return df.select(F.explode(entries).alias("e")).groupBy("e.column_name").agg(F.count_if("e.m").alias("missing"))


def coverage_qc(df: DataFrame, expected: DataFrame, keys: list[str], value: str, low: float, high: float) -> DataFrame:
    """Per year: rows, duplicate keys, missing and out-of-range values; expected years without rows are there with 0."""
    per_key = df.groupBy("year", *[k for k in keys if k != "year"]).agg(F.count(F.lit(1)).alias("n"), F.count_if(F.col(value).isNull()).alias("m"), F.count_if((F.col(value) < low) | (F.col(value) > high)).alias("o"))
    years = per_key.groupBy("year").agg(F.sum("n").alias("rows"), F.count_if(F.col("n") > 1).alias("duplicate_keys"), F.sum("m").alias("missing"), F.sum("o").alias("out_of_range"))
    return expected.join(years, "year", "left").fillna(0, ["rows", "duplicate_keys", "missing", "out_of_range"]).withColumn("present", F.col("rows") > 0)
