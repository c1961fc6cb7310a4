"""Exploratory statistics: exact, and spread over the cluster even where one group holds most rows.

Ranks and quantiles come from one primitive: distinct values are counted, dealt to ranges, and summed up range by range.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from functools import reduce
from itertools import combinations

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from terrasheaf.functions.keys import tillage_shares
from terrasheaf.runtime import join_counted, look_up, stored


def ranged(counts: DataFrame, keys: list[str], x: str, names: list[str]) -> DataFrame:
    """(keys, x, names, and before_<name> for each): how much of each count lies at smaller values of ``x`` in the group. ``counts`` has one row
    for each value.

    The values are dealt to ranges of (keys, x) by Spark's range partitioning, as many as the session has shuffle partitions for them: a group
    with many values gets many ranges and small groups share one. The ranges are stored, so they stay what they are when a task runs again,
    and summed up one by one."""
    dealt = stored(counts.repartitionByRange(*keys, x).withColumn("__range", F.spark_partition_id()), "ranges")
    totals = dealt.groupBy(*keys, "__range").agg(*(F.sum(n).alias(f"__{n}") for n in names))
    earlier = Window.partitionBy(*keys).orderBy("__range").rowsBetween(Window.unboundedPreceding, -1)
    starts = totals.select(*keys, "__range", *(F.coalesce(F.sum(f"__{n}").over(earlier), F.lit(0)).alias(f"__start_{n}") for n in names))
    inside = Window.partitionBy(*keys, "__range").orderBy(x).rowsBetween(Window.unboundedPreceding, -1)
    placed = dealt.withColumns({f"__inside_{n}": F.coalesce(F.sum(n).over(inside), F.lit(0)) for n in names})
    at = [F.col(f"{t}.{k}").eqNullSafe(F.col(f"b.{k}")) for t in "a" for k in [*keys, "__range"]]
    joined = placed.alias("a").join(starts.alias("b"), at)
    return joined.select(*(f"a.{c}" for c in [*keys, x, *names]), *((F.col(f"__start_{n}") + F.col(f"__inside_{n}")).alias(f"before_{n}") for n in names))


def cumulative(df: DataFrame, keys: list[str], x: str) -> DataFrame:
    """(keys, x, n, before): each distinct non-null value of ``x``, how often it occurs in its group and how many smaller ones there are. A null
    key is a group of its own."""
    counts = df.where(F.col(x).isNotNull()).groupBy(*keys, x).agg(F.count(F.lit(1)).alias("n"))
    return ranged(counts, keys, x, ["n"]).withColumnRenamed("before_n", "before")


def average_rank() -> Column:
    """The rank of a row of ``cumulative``, ties sharing their average."""
    return F.col("before") + (F.col("n") + 1) / 2


def avg_rank(df: DataFrame, x: str, keys: list[str], name: str = "rank") -> DataFrame:
    """(keys, x, rank, n): the rank of each distinct value within its group, ties sharing their average, and how many share it."""
    return cumulative(df, keys, x).select(*keys, x, average_rank().alias(name), "n")


def quantiles_of(ranked: DataFrame, keys: list[str], x: str, probs: dict[str, float | Column]) -> DataFrame:
    """Exact quantiles per group of a table made by ``cumulative``, by linear interpolation between the two values nearest to (n - 1) * p;
    a probability may be a column that is the same in all rows of a group, and a null one gives null."""
    totals = ranked.groupBy(*keys).agg(F.sum("n").alias("__total"))
    rows = ranked.join(totals, keys) if keys else ranked.crossJoin(F.broadcast(totals))
    spot = {name: (F.col("__total") - 1) * p for name, p in probs.items()}

    def at(where: Column) -> Column:
        return F.max(F.when((F.col("before") <= where) & (where < F.col("before") + F.col("n")), F.col(x).cast("double")))

    sums = [c for name, p in spot.items() for c in (at(F.floor(p)).alias(f"{name}__lo"), at(F.ceil(p)).alias(f"{name}__hi"), F.max(p - F.floor(p)).alias(f"{name}__part"))]
    done = rows.groupBy(*keys).agg(*sums)
    return done.select(*keys, *((F.col(f"{n}__lo") + (F.col(f"{n}__hi") - F.col(f"{n}__lo")) * F.col(f"{n}__part")).alias(n) for n in probs))


def with_rank(rows: DataFrame, x: str, keys: list[str], name: str = "rank") -> DataFrame:
    """The rows of a stored table whose ``x`` is not null, with its rank in their group; a null key is a group too."""
    named = {f"__k{i}": F.to_json(F.struct(F.col(k))) for i, k in enumerate(keys)}  # a struct's text is never null
    ranks = stored(avg_rank(rows, x, keys, name).withColumns(named).drop(*keys), "ranks")
    return join_counted(rows.where(F.col(x).isNotNull()).withColumns(named), ranks, [*named, x], "n").drop(*named, "n")


#: Buckets that a group's values are counted in, on either of two passes.
BUCKETS = 1024


def bucket(x: Column, low: Column, high: Column) -> Column:
    """Which of ``BUCKETS`` equal parts of (low, high) a value lies in; infinite ends are buckets of their own, NaN comes last."""
    part = F.least(F.lit(BUCKETS - 1), F.floor((x - low) / (high - low) * BUCKETS).cast("int"))
    wide = (high - low) == math.inf
    return F.when(F.isnan(x), BUCKETS).when(low == high, 0).when(wide & (x == low), 0).when(wide & (x == high), BUCKETS - 1).when(wide, 1).otherwise(part)


def quantiles(df: DataFrame, keys: list[str], x: str, probs: dict[str, float | Column]) -> DataFrame:
    """Exact quantiles per group of a stored table, by linear interpolation between the two values nearest to (n - 1) * p. A probability may be a
    column of ``keys``; a null one gives null. NaN is the largest value, as everywhere in Spark; a null key is a group.

    By selection, not by sorting: the values of a group are counted in ``BUCKETS`` buckets between its ends, the buckets that hold a wanted
    position are counted in as many again, and only values that share the last bucket are put in order. Counts are summed up before they are
    shuffled, so a group may hold most rows."""
    spot = {name: (F.col("total") - 1) * p for name, p in probs.items()}
    wanted = F.array_distinct(F.array_compact(F.array(*(f(p).cast("long") for p in spot.values() for f in (F.floor, F.ceil)))))
    v = df.where(F.col(x).isNotNull()).select(*keys, F.col(x).cast("double").alias("v"))
    plain = F.when(~F.isnan("v"), F.col("v"))
    ends = stored(v.groupBy(*keys).agg(F.min(plain).alias("low"), F.max(plain).alias("high"), F.count(F.lit(1)).alias("total")), "ends")

    def with_ends(rows: DataFrame, table: DataFrame, on: list[str]) -> DataFrame:
        match = F.lit(True)
        for k in on:
            match = match & F.col(f"l.{k}").eqNullSafe(F.col(f"r.{k}"))
        more = [c for c in table.columns if c not in on]
        return rows.alias("l").join(table.alias("r") if on else F.broadcast(table).alias("r"), match).select("l.*", *(f"r.{c}" for c in more))

    def chosen(rows: DataFrame, by: list[str], new: str) -> DataFrame:
        """The buckets ``new`` within ``by`` that hold a wanted position, with their own ends and the positions."""
        counts = rows.withColumn(new, bucket(F.col("v"), F.col("low"), F.col("high"))).groupBy(*by, new).agg(F.count(F.lit(1)).alias("n"), F.min("v").alias("low_"), F.max("v").alias("high_"), F.first("total").alias("total"), F.first("start").alias("start"))
        earlier = Window.partitionBy(*by).orderBy(new).rowsBetween(Window.unboundedPreceding, -1)
        placed = counts.withColumn("start", F.col("start") + F.coalesce(F.sum("n").over(earlier), F.lit(0)))
        ours = placed.withColumn("spots", F.filter(wanted, lambda t: (t >= F.col("start")) & (t < F.col("start") + F.col("n"))))
        return stored(ours.where(F.size("spots") > 0).select(*by, new, F.col("low_").alias("low"), F.col("high_").alias("high"), "total", "start", "spots"), "buckets")

    rows = with_ends(v, ends, keys).withColumn("start", F.lit(0).cast("long"))
    first = chosen(rows, keys, "b1")
    open_ = first.where("low < high").drop("spots")
    inner = with_ends(rows.withColumn("b1", bucket(F.col("v"), F.col("low"), F.col("high"))).select(*keys, "b1", "v"), open_, [*keys, "b1"])
    second = chosen(inner, [*keys, "b1"], "b2")
    last = second.where("low < high").drop("spots")
    left = with_ends(inner.withColumn("b2", bucket(F.col("v"), F.col("low"), F.col("high"))).select(*keys, "b1", "b2", "v"), last.select(*keys, "b1", "b2", "total", "start"), [*keys, "b1", "b2"])
    order = cumulative(left, [*keys, "b1", "b2", "total", "start"], "v").select(*keys, "total", (F.col("start") + F.col("before")).alias("start"), "n", "v")
    sorted_ = order.select(*keys, "total", "v", F.explode(F.filter(wanted, lambda t: (t >= F.col("start")) & (t < F.col("start") + F.col("n")))).alias("spot"))
    alone = [t.where("low = high").select(*keys, "total", F.col("low").alias("v"), F.explode("spots").alias("spot")) for t in (first, second)]
    found = sorted_.unionByName(alone[0]).unionByName(alone[1])
    at = lambda f, p: F.max(F.when(F.col("spot") == f(p).cast("long"), F.col("v")))
    done = found.groupBy(*keys).agg(*(c for n, p in spot.items() for c in (at(F.floor, p).alias(f"{n}__lo"), at(F.ceil, p).alias(f"{n}__hi"), F.max(p - F.floor(p)).alias(f"{n}__part"))))
    between = lambda n: F.when(F.col(f"{n}__part") == 0, F.col(f"{n}__lo")).otherwise(F.col(f"{n}__lo") + (F.col(f"{n}__hi") - F.col(f"{n}__lo")) * F.col(f"{n}__part"))
    return done.select(*keys, *(between(n).alias(n) for n in probs))


def unpivot(df: DataFrame, keep: list[str], variables: list[str]) -> DataFrame:
    """(keep, variable, value): one row per variable; NaN is null."""
    entries = F.array(*(F.struct(F.lit(v).alias("variable"), F.nanvl(F.col(v).cast("double"), F.lit(None).cast("double")).alias("value")) for v in variables))
    return df.select(*keep, F.explode(entries).alias("e")).select(*keep, "e.*")


def with_shares(df: DataFrame, nulls_as_zero: bool = True) -> DataFrame:
    return df.withColumns(tillage_shares(F.col("tillage_0_prop"), F.col("tillage_1_prop"), nulls_as_zero))


def dedupe_field_year(rows: DataFrame) -> DataFrame:
    """One row per field and year: the first by focal county and path."""
    rest = [c for c in rows.columns if c not in ("tile_field_ID", "year")]
    return rows.groupBy("tile_field_ID", "year").agg(F.min_by(F.struct(*rest), F.struct("focal_fips", "path")).alias("r")).select("tile_field_ID", "year", "r.*")


PROFILE = {"p05": 0.05, "p25": 0.25, "median": 0.5, "p75": 0.75, "p95": 0.95}


def numeric_profile(df: DataFrame, variables: list[str]) -> DataFrame:
    """Per variable: rows, non-null and missing rows, distinct values, mean, deviation (0 for one value), extremes and quantiles."""
    long = stored(unpivot(df, [], variables), "profile")
    v = F.col("value")
    base = long.groupBy("variable").agg(F.count(F.lit(1)).alias("rows"), F.count(v).alias("non_null"), F.count_if(v.isNull()).alias("missing"), F.avg(v).alias("mean"), F.coalesce(F.stddev_samp(v), F.when(F.count(v) == 1, 0.0)).alias("std"), F.min(v).alias("min"), F.max(v).alias("max"))
    distinct = long.dropna().distinct().groupBy("variable").agg(F.count(F.lit(1)).alias("distinct_values"))
    done = base.join(distinct, "variable", "left").join(quantiles(long, ["variable"], "value", PROFILE), "variable", "left")
    return done.withColumn("missing_rate", F.col("missing") / F.col("rows")).fillna({"distinct_values": 0})


MOMENTS = "pair int, n long, x_mean double, y_mean double, xx double, yy double, xy double, x_low double, x_high double, y_low double, y_high double"


def added(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """The moments (as in ``MOMENTS``, without the pair, a row each) of two sets of rows together."""
    n = a[0] + b[0]
    share, dx, dy = b[0] / np.maximum(n, 1), b[1] - a[1], b[2] - a[2]
    about = [a[3 + k] + b[3 + k] + d * e * a[0] * share for k, (d, e) in enumerate(((dx, dx), (dy, dy), (dx, dy)))]
    ends = [f(a[k], b[k]) for k, f in zip(range(6, 10), (np.minimum, np.maximum) * 2, strict=True)]
    return np.stack([n, a[1] + dx * share, a[2] + dy * share, *about, *ends])


def moments(rows: DataFrame, pairs: list[tuple[str, str]]) -> DataFrame:
    """``MOMENTS`` of pairs of columns over the rows that have both, numbered as in ``pairs``: means, sums of squares and products about them,
    and extremes. A pair without such rows is left out.

    A task sums up its rows batch by batch and sends one row for each pair; Spark's own aggregates of so many pairs take too many buffers to be
    compiled."""
    columns = list(dict.fromkeys(c for p in pairs for c in p))
    at = [(columns.index(x), columns.index(y)) for x, y in pairs]
    nothing = np.array([0, 0, 0, 0, 0, 0, math.inf, -math.inf, math.inf, -math.inf])[:, None].repeat(len(pairs), 1)
    kinds = [pa.int64(), *[pa.float64()] * 9]
    names = [c.split()[0] for c in MOMENTS.split(", ")]

    def table(state: np.ndarray, number: np.ndarray) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(number, pa.int32()), *(pa.array(v.astype(np.int64) if k == pa.int64() else v, k) for v, k in zip(state, kinds, strict=True))], names=names)

    def summed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        state = nothing
        with np.errstate(all="ignore"):
            for batch in batches:
                values = [c.to_numpy(zero_copy_only=False) for c in batch.columns]  # null: NaN
                has, new = [~np.isnan(v) for v in values], nothing.copy()
                for k, (i, j) in enumerate(at):
                    both = has[i] & has[j]
                    x, y = values[i][both], values[j][both]
                    if len(x):
                        low, high = (x.min(), y.min()), (x.max(), y.max())
                        mean = [low[m] if low[m] == high[m] else v.mean() for m, v in enumerate((x, y))]  # a constant's moments are exactly zero
                        dx, dy = x - mean[0], y - mean[1]
                        new[:, k] = len(x), *mean, dx @ dx, dy @ dy, dx @ dy, low[0], high[0], low[1], high[1]
                state = added(state, new)
        some = np.flatnonzero(state[0])
        yield table(state[:, some], some)

    def merged(key: tuple[pa.Scalar, ...], group: pa.Table) -> pa.Table:
        parts = np.stack([group.column(c).to_numpy().astype(np.float64) for c in names[1:]])
        with np.errstate(all="ignore"):
            state = reduce(added, (parts[:, k : k + 1] for k in range(parts.shape[1])))
        return pa.Table.from_batches([table(state, np.array([key[0].as_py()]))])

    return rows.select(*columns).mapInArrow(summed, MOMENTS).groupBy("pair").applyInArrow(merged, MOMENTS)


#: Variables with at most so many distinct values have their ranks broadcast.
LISTED = 100_000


def correlations(df: DataFrame, variables: list[str], pairs: list[tuple[int, int]]) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Of pairs (x, y) of variables over the rows that have both: (pair, n, x_mean, y_mean, pearson_r, spearman_r, slope), numbered as in ``pairs``;
    pairs without such rows are left out, and below three rows or where one does not vary correlations and slope are null. Also the rows as
    columns v0, v1 ..., and the ranks as (variable, value, n, many, before): lists by ranking, of how many rows have the value and how many
    a smaller one.

    Rows are written once, not once for each pair. For Spearman's a variable is ranked among the rows that have the other one, and partners
    that are missing in the same rows share a ranking: values are counted for all rankings of all variables in one pass. Rows stay whole while
    they get their ranks: those of a variable with few distinct values are broadcast, the others looked up by value."""
    size = len(variables)
    values = [F.nanvl(F.col(c).cast("double"), F.lit(None).cast("double")).alias(f"v{k}") for k, c in enumerate(variables)]
    pattern = sum((F.when(F.col(f"v{k}").isNotNull(), 1 << k).otherwise(0) for k in range(size)), F.lit(0).cast("long"))
    rows = stored(df.select(*values).withColumn("pattern", pattern), "rows")
    known = [r["pattern"] for r in rows.select("pattern").distinct().collect()]  # 2 ** size rows at most
    both = {p: frozenset(k for k in known if all(k >> v & 1 for v in p)) for i, j in pairs for p in ((i, j), (j, i))}
    sets = {i: list(dict.fromkeys(s for (v, _), s in both.items() if v == i and s)) for i in range(size)}
    width = max(1, *map(len, sets.values()))
    member = [(i, p, *(int(k < len(sets[i]) and p in sets[i][k]) for k in range(width))) for i in range(size) if sets[i] for p in known if p >> i & 1]
    names = [f"n{k}" for k in range(width)]
    of = df.sparkSession.createDataFrame(member, "variable int, pattern long, " + ", ".join(f"m{k} int" for k in range(width)))
    long = rows.select("pattern", F.explode(F.array(*(F.struct(F.lit(k).alias("variable"), F.col(f"v{k}").alias("value")) for k in range(size)))).alias("e")).select("pattern", "e.*").where("value IS NOT NULL")
    counts = long.join(F.broadcast(of), ["variable", "pattern"]).groupBy("variable", "value").agg(F.count(F.lit(1)).alias("n"), *(F.sum(f"m{k}").alias(n) for k, n in enumerate(names)))
    ranks = ranged(counts, ["variable"], "value", ["n", *names])
    ranks = stored(ranks.select("variable", "value", "n", F.array(*names).alias("many"), F.array(*(f"before_{n}" for n in names)).alias("before")), "ranks")
    distinct = {r["variable"]: r["n"] for r in ranks.groupBy("variable").agg(F.count(F.lit(1)).alias("n")).collect()}
    wide = rows.drop("pattern")
    for k in sorted(distinct, key=distinct.get, reverse=True):  # what is shuffled comes first
        rank = F.transform(F.arrays_zip("before", "many"), lambda e: e["before"] + (e["many"] + 1) / 2).alias(f"r{k}")
        table = ranks.where(F.col("variable") == k).select(F.col("value").alias(f"v{k}"), rank, "n")
        wide = wide.join(F.broadcast(table.drop("n")), f"v{k}", "left") if distinct[k] <= LISTED else look_up(wide, table, f"v{k}", "n")
    wide = wide.select(*(f"v{k}" for k in range(size)), *(F.col(f"r{k}")[m].alias(f"r{k}_{m}") for k in distinct for m in range(len(sets[k]))))
    place = lambda i, j: f"r{i}_{sets[i].index(both[i, j])}"
    some = [k for k, p in enumerate(pairs) if both[p]]
    asked = [(f"v{i}", f"v{j}") for i, j in (pairs[k] for k in some)] + [(place(i, j), place(j, i)) for i, j in (pairs[k] for k in some)]
    r = F.when((F.col("n") >= 3) & (F.col("x_low") < F.col("x_high")) & (F.col("y_low") < F.col("y_high")), F.try_divide("xy", F.nullif(F.sqrt("xx") * F.sqrt("yy"), F.lit(0.0))))
    slope = F.when(r.isNotNull(), F.try_divide("xy", F.nullif("xx", F.lit(0.0))))
    found = moments(wide, asked) if some else df.sparkSession.createDataFrame([], MOMENTS)
    found = found.select((F.col("pair") % max(1, len(some))).alias("k"), (F.col("pair") >= len(some)).alias("ranked"), "n", "x_mean", "y_mean", r.alias("r"), slope.alias("slope"))
    plain = lambda c: F.max(F.when(~F.col("ranked"), F.col(c)))
    done = found.groupBy("k").agg(*(plain(c).alias(c) for c in ("n", "x_mean", "y_mean")), plain("r").alias("pearson_r"), F.max(F.when(F.col("ranked"), F.col("r"))).alias("spearman_r"), plain("slope").alias("slope"))
    return done.withColumn("pair", F.element_at(F.array(*map(F.lit, some or [0])), F.col("k") + 1)).drop("k"), rows, ranks


def incomplete_beta(a: float, b: float, x: float) -> float:
    """The regularised incomplete beta function, by its continued fraction."""
    if x <= 0 or x >= 1:
        return float(x >= 1)
    if x > (a + 1) / (a + b + 2):
        return 1 - incomplete_beta(b, a, 1 - x)
    front = math.exp(math.lgamma(a + b) - math.lgamma(a) - math.lgamma(b) + a * math.log(x) + b * math.log1p(-x)) / a
    tiny, c, d = 1e-300, 1.0, 1 - (a + b) * x / (a + 1)
    d = 1 / (d if abs(d) > tiny else tiny)
    f = d
    for m in range(1, 500):
        for step in (m * (b - m) * x / ((a + 2 * m - 1) * (a + 2 * m)), -(a + m) * (a + b + m) * x / ((a + 2 * m) * (a + 2 * m + 1))):
            d = 1 + step * d
            c = 1 + step / c
            d, c = 1 / (d if abs(d) > tiny else tiny), c if abs(c) > tiny else tiny
            f *= d * c
        if abs(d * c - 1) < 1e-15:
            break
    return front * f


def p_value(r: float | None, n: int) -> float | None:
    """Two-sided t-test of a correlation."""
    if r is None or math.isnan(r) or n < 3:
        return None
    if abs(r) >= 1:
        return 0.0
    df = n - 2
    return incomplete_beta(df / 2, 0.5, df / (df + r * r * df / (1 - r * r)))


def corr_p_value(r: Column, n: Column) -> Column:
    """The p-values of a table of correlations, a few rows long."""

    @F.pandas_udf("double")
    def test(r: pd.Series, n: pd.Series) -> pd.Series:
        return pd.Series([p_value(None if pd.isna(a) else float(a), int(b)) for a, b in zip(r, n, strict=True)], dtype="float64")

    return test(r, n.cast("long"))


def yield_bivariate(df: DataFrame, predictors: list[str], y: str = "unscaled_yield") -> DataFrame:
    """Per predictor: correlations with p-values, the line of least squares, and mean yield in the lowest and highest quarter of it."""
    base, rows, ranks = correlations(df, [y, *predictors], [(k, 0) for k in range(1, len(predictors) + 1)])
    named = F.array(*map(F.lit, predictors))
    base = base.withColumn("predictor", F.element_at(named, F.col("pair") + 1)).withColumns({"intercept": F.col("y_mean") - F.col("slope") * F.col("x_mean"), "r2": F.col("pearson_r") * F.col("pearson_r")}).drop("pair")
    ranked = ranks.where("variable > 0 AND many[0] > 0").select(F.element_at(named, F.col("variable")).alias("predictor"), F.col("value").alias("x"), F.col("many")[0].alias("n"), F.col("before")[0].alias("before"))
    cuts = quantiles_of(ranked, ["predictor"], "x", {"q25": 0.25, "q75": 0.75})
    pairs = rows.select(F.col("v0").alias("y"), F.explode(F.array(*(F.struct(F.lit(p).alias("predictor"), F.col(f"v{k}").alias("x")) for k, p in enumerate(predictors, 1)))).alias("e")).select("y", "e.*").dropna()
    ends = pairs.join(F.broadcast(cuts), "predictor").groupBy("predictor").agg(F.avg(F.when(F.col("x") <= F.col("q25"), F.col("y"))).alias("low_mean"), F.avg(F.when(F.col("x") >= F.col("q75"), F.col("y"))).alias("high_mean"))
    done = base.join(ends, "predictor")
    return done.withColumns({"pearson_p": corr_p_value(F.col("pearson_r"), F.col("n")), "spearman_p": corr_p_value(F.col("spearman_r"), F.col("n"))})


def pairwise_corr(df: DataFrame, variables: list[str]) -> DataFrame:
    """Both correlations of every two variables over the rows that have both: (a, b, n, pearson_r, spearman_r); pairs without such rows are left
    out."""
    pairs = list(combinations(range(len(variables)), 2))
    found, _, _ = correlations(df, variables, pairs)
    name = lambda side: F.element_at(F.array(*(F.lit(variables[p[side]]) for p in pairs)), F.col("pair") + 1)
    return found.select(name(0).alias("a"), name(1).alias("b"), "n", "pearson_r", "spearman_r")


def binned_yield(df: DataFrame, predictors: list[str], bins: int = 10, y: str = "unscaled_yield", by_value: tuple[str, ...] = ("annual_tillage",)) -> DataFrame:
    """Yield by quantile bins of each predictor: (predictor, bin_order, bin_low, bin_high, n, x_min, x_max, x_mean, y_mean, y_median).

    Bins are ``bins`` or as many as there are distinct values, right-closed, the lowest value included, equal edges joined, and numbered from
    1 in order where they have rows. A predictor of ``by_value`` or with two values at most has a bin for each value, which is its order and
    edges too. A predictor without complete pairs has no rows."""
    keys = ["predictor"]
    pairs = unpivot(df.withColumn("y", F.nanvl(F.col(y).cast("double"), F.lit(None).cast("double"))), ["y"], predictors)
    pairs = stored(pairs.select(F.col("variable").alias("predictor"), F.col("value").alias("x"), "y").dropna(), "pairs")
    few = pairs.select(*keys, "x").distinct().groupBy(*keys).agg(F.count(F.lit(1)).alias("__few"))
    few = stored(few.withColumn("__cut", F.least(F.lit(bins), F.col("__few"))), "few")  # one row a predictor
    probs = {f"e{k}": F.when(F.lit(k) <= F.col("__cut"), F.lit(k) / F.col("__cut")) for k in range(bins + 1)}
    cut = pairs.join(F.broadcast(few.select(*keys, "__cut")), keys)
    edges = quantiles(cut, [*keys, "__cut"], "x", probs).select(*keys, F.array_sort(F.array_distinct(F.array_compact(F.array(*probs)))).alias("edges"))
    single = (F.col("__few") <= 2) | F.col("predictor").isin(*by_value)
    made = few.join(edges, keys).select("predictor", single.alias("single"), "edges")  # one row a predictor
    number = F.size(F.filter(F.slice("edges", 2, F.greatest(F.size("edges") - 2, F.lit(0))), lambda e: e < F.col("x"))) + 1
    binned = stored(pairs.join(F.broadcast(made), keys).select("predictor", "x", "y", F.when(F.col("single"), F.col("x")).otherwise(number).alias("bin")), "binned")
    base = binned.groupBy("predictor", "bin").agg(F.count(F.lit(1)).alias("n"), F.min("x").alias("x_min"), F.max("x").alias("x_max"), F.avg("x").alias("x_mean"), F.avg("y").alias("y_mean"))
    done = base.join(quantiles(binned, ["predictor", "bin"], "y", {"y_median": 0.5}), ["predictor", "bin"]).join(F.broadcast(made), keys)
    order = F.when(F.col("single"), F.col("bin")).otherwise(F.dense_rank().over(Window.partitionBy("predictor").orderBy("bin")).cast("double"))
    edge = lambda k: F.when(F.col("single"), F.col("bin")).otherwise(F.coalesce(F.try_element_at("edges", (F.col("bin") + k).cast("int")), F.try_element_at("edges", F.lit(1))))
    return done.select("predictor", order.alias("bin_order"), edge(0).alias("bin_low"), edge(1).alias("bin_high"), "n", "x_min", "x_max", "x_mean", "y_mean", "y_median")


def group_summary(df: DataFrame, group: str, value: str) -> DataFrame:
    """Per group: number, mean, median and deviation (0 for one row) of a value."""
    rows = stored(df.where(F.col(group).isNotNull() & F.col(value).isNotNull()).select(group, value), "groups")
    base = rows.groupBy(group).agg(F.count(value).alias("n"), F.avg(value).alias("mean"), F.coalesce(F.stddev_samp(value), F.lit(0.0)).alias("std"))
    return base.join(quantiles(rows, [group], value, {"median": 0.5}), group)


def box_stats(df: DataFrame, group: str, value: str) -> DataFrame:
    """Quartiles and whisker ends (within one and a half interquartile ranges) of a value per group."""
    rows = stored(df.where(F.col(group).isNotNull() & F.col(value).isNotNull()).select(group, value), "groups")
    q = quantiles(rows, [group], value, {"q1": 0.25, "median": 0.5, "q3": 0.75})
    reach = 1.5 * (F.col("q3") - F.col("q1"))
    ends = rows.join(q, group).groupBy(group).agg(F.min(F.when(F.col(value) >= F.col("q1") - reach, F.col(value))).alias("whisker_low"), F.max(F.when(F.col(value) <= F.col("q3") + reach, F.col(value))).alias("whisker_high"))
    return q.join(ends, group)


def county_profile(rows: DataFrame, means: list[str]) -> DataFrame:
    """Per focal county: rows, distinct fields, field-years and source counties, year span and means."""
    return rows.groupBy("focal_fips").agg(F.count(F.lit(1)).alias("rows"), F.count_distinct("tile_field_ID").alias("fields"), F.count_distinct("tile_field_ID", "year").alias("field_years"), F.count_distinct("FIPS").alias("source_counties"), F.min("year").alias("year_min"), F.max("year").alias("year_max"), *(F.avg(c).alias(f"mean_{c}") for c in means))


def county_bivariate(rows: DataFrame, predictors: list[str], y: str = "unscaled_yield") -> DataFrame:
    """Per focal county and predictor: pairs, correlation and line, from one pass over the unpivoted rows."""
    long = unpivot(rows.withColumn("y", F.col(y).cast("double")), ["focal_fips", "y"], predictors)
    full = long.withColumnRenamed("value", "x").dropna(subset=["x", "y"])
    ok = (F.min("x") < F.max("x")) & (F.min("y") < F.max("y"))
    r = F.when(ok, F.try_divide(F.covar_samp("x", "y"), F.nullif(F.stddev_samp("x") * F.stddev_samp("y"), F.lit(0.0))))
    slope = F.when(ok, F.try_divide(F.covar_samp("x", "y"), F.nullif(F.var_samp("x"), F.lit(0.0))))
    return full.groupBy("focal_fips", F.col("variable").alias("predictor")).agg(F.count(F.lit(1)).alias("n"), r.alias("r"), slope.alias("slope"), (F.avg("y") - slope * F.avg("x")).alias("intercept"), (r * r).alias("r2"))


def duplicate_conflicts(rows: DataFrame, columns: list[str]) -> DataFrame:
    """How many field-years hold more than one value of some column."""
    differs = F.lit(False)
    for c in columns:
        differs = differs | (F.col(f"lo_{c}") < F.col(f"hi_{c}"))
    spans = rows.groupBy("tile_field_ID", "year").agg(*(f(c).alias(f"{n}_{c}") for c in columns for n, f in (("lo", F.min), ("hi", F.max))))
    return spans.agg(F.count_if(F.coalesce(differs, F.lit(False))).alias("conflicts"))


def eda_summary(repeated: DataFrame, unique: DataFrame) -> DataFrame:
    a = repeated.agg(F.count(F.lit(1)).alias("neighborhood_rows"), F.count_distinct("focal_fips").alias("focal_counties"), F.min("year").alias("year_min"), F.max("year").alias("year_max"))
    b = unique.agg(F.count(F.lit(1)).alias("unique_rows"), F.count_distinct("tile_field_ID").alias("unique_fields"))
    return a.crossJoin(F.broadcast(b)).withColumn("duplication_factor", F.try_divide(F.col("neighborhood_rows"), F.col("unique_rows")))


def strongest_signals(stats: DataFrame, k: int, r: str, keys: list[str]) -> DataFrame:
    """The ``k`` rows with the largest absolute correlation."""
    return stats.where(F.col(r).isNotNull()).orderBy(F.abs(F.col(r)).desc(), *keys).limit(k)


def plot_sample(df: DataFrame, columns: list[str], keys: list[str], n: int = 50_000, seed: int = 42) -> DataFrame:
    """At most ``n`` complete rows, the first by a hash of their key."""
    return df.dropna(subset=columns).orderBy(F.md5(F.concat_ws("|", *(F.col(k).cast("string") for k in keys), F.lit(str(seed))).cast("binary")), *keys).limit(n)


def union_predictors(frames: list[DataFrame]) -> DataFrame:
    out = frames[0]
    for frame in frames[1:]:
        out = out.unionByName(frame)
    return out

