"""Overlapping county neighbourhoods and model preparation in them."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from terrasheaf.operators.stats import quantiles
from terrasheaf.runtime import stored


def distinct_edges(edges: DataFrame) -> DataFrame:
    """Neighbour pairs once each, without blanks."""
    clean = lambda c: F.nullif(F.trim(F.col(c)), F.lit(""))
    return edges.select(clean("fipscounty").alias("focal_fips"), clean("fipsneighbor").alias("neighbor_fips")).dropna().distinct()


def focal_set(rows: DataFrame, edges: DataFrame) -> DataFrame:
    """Counties that both the data and the adjacency know; if there are none, all counties of the data."""
    data = rows.select(F.col("FIPS").alias("focal_fips")).distinct()
    both = data.join(edges.select("focal_fips").distinct(), "focal_fips", "left_semi")
    some = both.limit(1).agg(F.count(F.lit(1)).alias("n"))
    fallback = data.crossJoin(F.broadcast(some)).where("n = 0").select("focal_fips")
    return both.unionByName(fallback)


def neighborhood_expand(rows: DataFrame, edges: DataFrame, include_self: bool = False) -> DataFrame:
    """Each row once per focal county that lists its county as a neighbour. A focal county belongs to its own neighbourhood only if the
    edges say so (or ``include_self``); one without edges is its own neighbourhood."""
    focal = focal_set(rows, edges)
    lone = focal.join(edges, "focal_fips", "left_anti").select("focal_fips", F.col("focal_fips").alias("neighbor_fips"))
    pairs = edges.join(focal, "focal_fips", "left_semi").unionByName(lone)
    if include_self:
        pairs = pairs.unionByName(focal.select("focal_fips", F.col("focal_fips").alias("neighbor_fips")))
    return rows.join(pairs.distinct(), rows["FIPS"] == F.col("neighbor_fips")).drop("neighbor_fips")


def manifest_join(rows: DataFrame, manifest: DataFrame) -> DataFrame:
    return rows.join(manifest, "focal_fips", "left")


def neighborhood_manifest(rows: DataFrame, edges: DataFrame, counts: DataFrame | None = None) -> DataFrame:
    """Per focal county: neighbours, rows of the neighbourhood, year span, its own joined rows, and the sources' row counts if they are given.

    Rows are counted by county first, and the counts are expanded to neighbourhoods."""
    own = stored(rows.groupBy("FIPS").agg(F.count(F.lit(1)).alias("joined_row_count"), F.min("year").alias("y0"), F.max("year").alias("y1")), "counts")
    focal = focal_set(own, edges)
    many = edges.groupBy("focal_fips").agg(F.count(F.lit(1)).alias("neighbor_count"))
    size = neighborhood_expand(own, edges).groupBy("focal_fips").agg(F.sum("joined_row_count").alias("row_count"), F.min("y0").alias("year_min"), F.max("y1").alias("year_max"))
    mine = own.select(F.col("FIPS").alias("focal_fips"), "joined_row_count")
    done = focal.join(many, "focal_fips", "left").join(size, "focal_fips", "left").join(mine, "focal_fips", "left")
    done = done.fillna({"neighbor_count": 1, "row_count": 0, "joined_row_count": 0})
    return done if counts is None else done.crossJoin(F.broadcast(counts))


def neighborhood_diagnostics(manifest: DataFrame, sources: list[str]) -> DataFrame:
    return manifest.select("focal_fips", "neighbor_count", *(F.col(c).alias(f"source_{c}") for c in sources), "joined_row_count", F.col("row_count").alias("output_row_count"), "year_min", "year_max")


def complete_cases(df: DataFrame, columns: list[str]) -> DataFrame:
    return df.dropna(subset=columns)


def scaling_factors(rows: DataFrame, covariates: list[str]) -> DataFrame:
    """Mean and sample deviation of each covariate in each neighbourhood; the year is left as it is."""
    names = F.stack(F.lit(len(covariates)), *(x for c in covariates for x in (F.lit(c), F.col(c).cast("double")))).alias("covariate", "value")
    found = rows.select("focal_fips", names).groupBy("focal_fips", "covariate").agg(F.avg("value").alias("mean"), F.stddev_samp("value").alias("sd"))
    year = rows.select("focal_fips").distinct().select("focal_fips", F.lit("year").alias("covariate"), F.lit(0.0).alias("mean"), F.lit(1.0).alias("sd"))
    return found.unionByName(year)


def prior_table(scaling: DataFrame, effects: DataFrame, intercept: tuple[float, float] = (2250.0, 500.0)) -> DataFrame:
    """Prior mean and deviation of each main effect, and of the intercept."""
    rows = scaling.join(F.broadcast(effects), "covariate")
    main = rows.select("focal_fips", F.col("covariate").alias("term"), (F.col("effect") * F.col("sd")).alias("prior_mean"), F.abs(F.col("effect") * F.col("sd")).alias("prior_sd"))
    return main.unionByName(scaling.select("focal_fips").distinct().select("focal_fips", F.lit("Intercept").alias("term"), F.lit(intercept[0]).alias("prior_mean"), F.lit(intercept[1]).alias("prior_sd")))


def target_counties(rows: DataFrame, min_n: int, states: list[str], vpd_min: float, without_year: int) -> DataFrame:
    """Counties of allowed states with enough rows whose largest yearly mean of July's VPD, leaving one year out, is above a limit."""
    years = rows.where(F.col("state").isin(states)).groupBy("FIPS", "year").agg(F.count(F.lit(1)).alias("n"), F.avg("vpdmax_7").alias("vpd"))
    return years.groupBy("FIPS").agg(F.sum("n").alias("n"), F.max(F.when(F.col("year") != without_year, F.col("vpd"))).alias("max_vpd")).where((F.col("n") >= min_n) & (F.col("max_vpd") > vpd_min))


def mean_within(df: DataFrame, x: str, keys: list[str]) -> DataFrame:
    """The mean of ``x`` in each group and each row's distance from it; the mean is joined back, so that a large group can be split."""
    means = df.groupBy(*keys).agg(F.avg(x).alias(f"{x}_mean"))
    return df.join(means, keys).withColumn(f"{x}_within", F.col(x) - F.col(f"{x}_mean"))


def design_matrix(rows: DataFrame, covariates: list[str], base_year: int = 2010) -> DataFrame:
    """Covariates scaled within their neighbourhood, years from ``base_year`` on, and tillage's products with the others."""
    stats = rows.groupBy("focal_fips").agg(*(f(c).alias(f"{n}_{c}") for c in covariates for n, f in (("m", F.avg), ("s", F.stddev_samp))))
    z = lambda c: F.try_divide(F.col(c) - F.col(f"m_{c}"), F.nullif(F.col(f"s_{c}"), F.lit(0.0)))
    done = rows.join(stats, "focal_fips").withColumns({f"z_{c}": z(c) for c in covariates} | {"year_c": F.col("year") - base_year})
    first, others = covariates[0], covariates[1:]
    return done.withColumns({f"z_{first}_x_{c}": F.col(f"z_{first}") * F.col(f"z_{c}") for c in others}).drop(*(f"{n}_{c}" for n in "ms" for c in covariates))


#: Triangles that are joined at a time, and neighbourhoods whose triangles a task holds.
FAN, HELD = 32, 10_000


def triangle(blocks: list[np.ndarray]) -> np.ndarray:
    """The triangular factor of matrices on top of each other; with fewer rows than columns, filled up with zeros."""
    stacked = np.concatenate(blocks)
    r = np.linalg.qr(stacked, mode="r")
    return np.concatenate([r, np.zeros((stacked.shape[1] - len(r), stacked.shape[1]))])


def neighborhood_ols(design: DataFrame, y: str, xs: list[str]) -> DataFrame:
    """Least squares per neighbourhood: (focal_fips, term, estimate, n), with term 1 for the intercept.

    A tall, narrow QR factorisation: each task reduces its rows of a neighbourhood to the triangle of [1, xs, y], and triangles are joined to
    one in a tree, ``FAN`` at a time; its upper left part has the singular values of the matrix itself, where cross products would have their
    squares. Collinear columns get the solution of least norm. Rows with a null or NaN are left out."""
    names = ["1", *xs]
    columns = [F.lit(1.0).alias("x0"), *(F.col(x).cast("double").alias(f"x{k}") for k, x in enumerate(xs, 1)), F.col(y).cast("double").alias("y")]
    rows = design.dropna(subset=["focal_fips", y, *xs]).select(F.col("focal_fips").cast("string").alias("focal_fips"), *columns)
    width = len(names) + 1
    schema = "focal_fips string, node long, n long, r binary"

    def sent(held: dict[str, tuple[int, np.ndarray]], node: int) -> pa.RecordBatch:
        data = [list(held), [node] * len(held), [n for n, _ in held.values()], [r.tobytes() for _, r in held.values()]]
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(data, (pa.string(), pa.int64(), pa.int64(), pa.binary()), strict=True)], names=["focal_fips", "node", "n", "r"])

    def reduced(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        node, held = TaskContext.get().partitionId(), {}
        for batch in batches:
            keys = batch.column(0).dictionary_encode()
            matrix = np.stack([batch.column(k).to_numpy(zero_copy_only=False) for k in range(1, width + 1)], 1)
            code = keys.indices.to_numpy()
            order = np.argsort(code, kind="stable")
            ends = np.searchsorted(code[order], np.arange(len(keys.dictionary) + 1))
            for k, key in enumerate(keys.dictionary.to_pylist()):
                n, r = held.get(key, (0, np.zeros((0, width))))
                held[key] = n + int(ends[k + 1] - ends[k]), triangle([r, matrix[order[ends[k] : ends[k + 1]]]])
            if len(held) > HELD:
                yield sent(held, node)
                held = {}
        yield sent(held, node)

    def joined(key: tuple[pa.Scalar, ...], group: pa.Table) -> pa.Table:
        n = sum(group.column("n").to_pylist())
        r = triangle([np.frombuffer(x.as_py()).reshape(width, width) for x in group.column("r")])
        return pa.Table.from_batches([sent({key[0].as_py(): (n, r)}, key[1].as_py())])

    parts = stored(rows.mapInArrow(reduced, schema), "triangles")
    nodes = 1 + (parts.agg(F.max("node")).first()[0] or 0)
    while nodes > 1:
        nodes = -(-nodes // FAN)
        parts = parts.withColumn("node", F.floor(F.col("node") / FAN)).groupBy("focal_fips", "node").applyInArrow(joined, schema)
        if nodes > 1:
            parts = stored(parts, "triangles")

    def solved(key: tuple[pa.Scalar, ...], group: pa.Table) -> pa.Table:
        r = triangle([np.frombuffer(x.as_py()).reshape(width, width) for x in group.column("r")])
        beta = np.linalg.lstsq(r[:-1, :-1], r[:-1, -1], rcond=None)[0]
        return pa.table({"focal_fips": [key[0].as_py()] * len(names), "term": names, "estimate": beta, "n": [sum(group.column("n").to_pylist())] * len(names)})

    return parts.groupBy("focal_fips").applyInArrow(solved, "focal_fips string, term string, estimate double, n long")


def draws_summary(draws: DataFrame, probs: tuple[float, float] = (0.05, 0.95)) -> DataFrame:
    """Mean, deviation and two quantiles of each variable of each fit."""
    keys, rows = ["fit", "variable"], stored(draws.select("fit", "variable", "value"), "draws")
    base = rows.groupBy(*keys).agg(F.avg("value").alias("mean"), F.stddev_samp("value").alias("sd"))
    return base.join(quantiles(rows, keys, "value", {f"q{round(100 * q)}": q for q in probs}), keys, "left")


def read_states(spark: SparkSession, paths: str | list[str]) -> DataFrame:
    """Fit summaries and checkpoints of counties, JSON files of one object a line; a summary that was not written yet has no counts."""
    return spark.read.schema("fips string, completed_iter long, target_iter long").json(paths)


def fit_manifest(states: DataFrame) -> DataFrame:
    """Per county the state of its fit, from completed and wanted iterations."""
    rows = states.groupBy("fips").agg(F.max("completed_iter").alias("completed_iter"), F.max("target_iter").alias("target_iter"))
    done, want = F.coalesce("completed_iter", F.lit(0)), F.col("target_iter")
    return rows.select("fips", done.alias("completed_iter"), "target_iter", F.when(done == 0, "pending").when(done < want, "needs_more").otherwise("complete").alias("status"))
