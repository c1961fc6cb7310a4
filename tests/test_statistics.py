"""Selection of quantiles, pairwise correlations, least squares and co-partitioned joins."""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from terrasheaf.operators import covariates as C
from terrasheaf.operators import neighborhood as N
from terrasheaf.operators import stats as T
from terrasheaf.runtime import bucketed, stored


def spread(kind, rng, n=3000):
    made = {
        "normal": lambda: rng.normal(size=n),
        "ties": lambda: rng.integers(0, 3, n).astype(float),
        "one value": lambda: np.full(n, 7.25),
        "huge range": lambda: np.exp(rng.uniform(-600, 600, n)) * rng.choice([-1, 1], n),
        "one outlier": lambda: np.append(rng.normal(size=n), 1e300),
        "infinite": lambda: np.concatenate([rng.normal(size=50), [math.inf] * 9, [-math.inf] * 4]),
        "widest": lambda: np.concatenate([rng.normal(size=50), [1.7e308, -1.7e308]]),
        "two": lambda: np.array([1.0, 4.0]),
        "one": lambda: np.array([3.5]),
    }
    return made[kind]()


def test_quantiles_equal_numpy(spark):
    rng = np.random.default_rng(5)
    probs = {"p0": 0.0, "p05": 0.05, "median": 0.5, "p95": 0.95, "p1": 1.0}
    groups = {k: spread(k, rng) for k in ("normal", "ties", "one value", "huge range", "one outlier", "infinite", "widest", "two", "one")}
    groups[None] = rng.normal(size=99)
    rows = [(k, float(v)) for k, values in groups.items() for v in values] + [(k, None) for k in ("normal", "none")]
    df = stored(spark.createDataFrame(rows, "k string, v double").repartition(5), "given")
    got = {r["k"]: r for r in T.quantiles(df, ["k"], "v", probs).collect()}
    assert set(got) == set(groups)
    for k, values in groups.items():
        for name, p in probs.items():
            with np.errstate(invalid="ignore", over="ignore"):
                x = np.sort(values)
                at = (len(x) - 1) * p
                low, high = x[math.floor(at)], x[math.ceil(at)]
                want = low if at == math.floor(at) else low + (high - low) * (at - math.floor(at))
            assert got[k][name] == pytest.approx(want, rel=1e-12, nan_ok=True), (k, name)
    whole = T.quantiles(stored(df.where("k = 'normal'"), "given"), [], "v", {"q": 0.3}).first()["q"]
    assert whole == pytest.approx(np.quantile(groups["normal"], 0.3))
    assert T.quantiles(df.where("k = 'none'"), ["k"], "v", probs).collect() == []


def test_nan_is_the_largest_value(spark):
    df = stored(spark.createDataFrame([("a", v) for v in (1.0, 2.0, math.nan, 0.0)] + [("b", math.nan)], "k string, v double"), "given")
    got = {r["k"]: r for r in T.quantiles(df, ["k"], "v", {"low": 0.0, "mid": 2 / 3, "top": 1.0}).collect()}
    assert got["a"]["low"] == 0 and got["a"]["mid"] == 2 and math.isnan(got["a"]["top"]) and math.isnan(got["b"]["low"])


def test_quantiles_do_not_order_all_values(spark):
    df = stored(spark.range(20_000).select(F.lit("a").alias("k"), F.rand(1).alias("v")), "given")
    plan = T.quantiles(df, ["k"], "v", {"m": 0.5})._jdf.queryExecution().optimizedPlan().toString()
    assert "RepartitionByExpression" not in plan  # what is ordered has been written already, and is a few rows
    assert T.quantiles(df, ["k"], "v", {"m": 0.5}).first()["m"] == pytest.approx(np.quantile([r["v"] for r in df.collect()], 0.5))


def test_pairwise_correlations_by_pandas(spark):
    rng = np.random.default_rng(6)
    n = 400
    frame = pd.DataFrame({"a": rng.normal(size=n), "b": rng.integers(0, 4, n).astype(float), "c": rng.normal(size=n), "d": np.full(n, 2.0), "e": rng.normal(size=n), "f": np.full(n, np.nan), "g": np.full(n, np.nan)})
    frame["c"] += frame["a"]
    frame.loc[rng.random(n) < 0.3, "b"] = np.nan
    frame.loc[rng.random(n) < 0.3, ["c", "e"]] = np.nan
    frame.loc[:1, "g"] = [1.0, 3.0]
    names = list(frame.columns)
    df = spark.createDataFrame([tuple(None if pd.isna(x) else float(x) for x in r) for r in frame.itertuples(index=False)], ", ".join(f"{c} double" for c in names)).repartition(4)
    got = {(r["a"], r["b"]): r for r in T.pairwise_corr(df, names).collect()}
    for i, a in enumerate(names):
        for b in names[i + 1 :]:
            both = frame[[a, b]].dropna()
            if not len(both):
                assert (a, b) not in got
                continue
            r = got[a, b]
            assert r["n"] == len(both)
            if len(both) < 3 or both[a].nunique() < 2 or both[b].nunique() < 2:
                assert r["pearson_r"] is None and r["spearman_r"] is None
            else:
                assert r["pearson_r"] == pytest.approx(both[a].corr(both[b])) and r["spearman_r"] == pytest.approx(both[a].rank().corr(both[b].rank()))
    assert T.pairwise_corr(df.where("a > 99"), names).collect() == []


def test_ranks_of_a_null_group(spark):
    df = stored(spark.createDataFrame([(None, 2.0), (None, 1.0), ("x", 5.0), ("x", 5.0), ("x", None)], "k string, v double"), "given")
    assert sorted(((r["k"] or "", r["v"], r["rank"]) for r in T.with_rank(df, "v", ["k"]).collect())) == [("", 1.0, 1.0), ("", 2.0, 2.0), ("x", 5.0, 1.5), ("x", 5.0, 1.5)]


def test_least_squares_where_cross_products_fail(spark, monkeypatch):
    monkeypatch.setattr(N, "FAN", 2)
    rng = np.random.default_rng(7)
    n = 600
    x1 = rng.normal(size=n)
    x2 = x1 + 1e-8 * rng.normal(size=n)  # a condition of some 1e8, whose square is past what doubles hold
    y = 2 + 3 * x1 - x2 + 1e-10 * rng.normal(size=n)
    rows = [("a", float(a), float(b), float(c)) for a, b, c in zip(x1, x2, y)] + [("b", 1.0, 2.0, 5.0), ("b", 1.0, 2.0, 5.0), ("c", None, 1.0, 1.0)]
    df = spark.createDataFrame(rows, "focal_fips string, x1 double, x2 double, y double").repartition(7)
    got = {(r["focal_fips"], r["term"]): r for r in N.neighborhood_ols(df, "y", ["x1", "x2"]).collect()}
    matrix = np.stack([np.ones(n), x1, x2], 1)
    want = np.linalg.lstsq(matrix, y, rcond=None)[0]
    mine = np.array([got["a", t]["estimate"] for t in ("1", "x1", "x2")])
    assert np.abs(mine - want).max() < 1e-2 and np.abs(matrix @ mine - y).max() < 1e-9 and got["a", "1"]["n"] == n
    crossed = np.linalg.lstsq(matrix.T @ matrix, matrix.T @ y, rcond=None)[0]
    assert np.abs(crossed - want).max() > 0.1
    least = np.linalg.lstsq(np.array([[1.0, 1.0, 2.0]] * 2), np.array([5.0, 5.0]), rcond=None)[0]
    assert [got["b", t]["estimate"] for t in ("1", "x1", "x2")] == pytest.approx(least.tolist()) and ("c", "1") not in got


def test_copartitioned_tables_join_without_an_exchange(spark):
    limit = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        years = spark.range(400).select(F.concat(F.lit("f"), F.col("id") % 50).alias("tile_field_ID"), (F.col("id") / 50).cast("int").alias("year"), F.col("id").alias("n"))
        fields = spark.range(50).select(F.concat(F.lit("f"), "id").alias("tile_field_ID"))
        tables = [years.withColumnRenamed("n", c) for c in ("yield", "tillage", "vpd")] + [fields.withColumn(c, F.lit(1)) for c in ("soil", "county")]
        kept = [bucketed(df, "t", ["tile_field_ID"], 6) for df in tables]
        joined = C.copartitioned_join(*kept)
        plan = joined._jdf.queryExecution().executedPlan().toString()
        assert plan.count("SortMergeJoin") == 4 and "Exchange" not in plan
        order = lambda df: sorted(map(tuple, df.collect()))
        assert order(joined) == order(C.covariate_join(*tables)) and joined.count() == 400 and "Exchange" in C.covariate_join(*tables)._jdf.queryExecution().executedPlan().toString()
        assert not [x for x in spark.catalog.listTables() if x.name.startswith("written_")]
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", limit)


def test_moments_of_pairs_equal_numpy(spark):
    rng = np.random.default_rng(8)
    pdf = pd.DataFrame({"a": 1e9 + rng.normal(size=5000), "b": rng.normal(size=5000), "c": np.full(5000, 0.1), "d": rng.normal(size=5000)})
    pdf.loc[rng.random(5000) < 0.4, "b"] = None
    pdf.loc[7, "d"] = math.inf
    pairs = [("a", "b"), ("b", "c"), ("a", "d")]
    df = spark.createDataFrame(pdf.astype(object).where(pdf.notna(), None).values.tolist(), "a double, b double, c double, d double").repartition(7)
    got = {r["pair"]: r for r in T.moments(df, pairs).collect()}
    for k, (x, y) in enumerate(pairs[:2]):
        full = pdf[[x, y]].dropna()
        assert got[k]["n"] == len(full) and (got[k]["x_low"], got[k]["x_high"]) == (full[x].min(), full[x].max())
        dx, dy = full[x] - math.fsum(full[x]) / len(full), full[y] - math.fsum(full[y]) / len(full)
        assert got[k]["xx"] == pytest.approx((dx * dx).sum(), rel=1e-7) and got[k]["x_mean"] == pytest.approx(full[x].mean(), rel=1e-13)
        assert got[k]["xy"] == pytest.approx((dx * dy).sum(), rel=1e-6, abs=1e-9)
    assert got[1]["yy"] == 0.0  # of a constant exactly
    assert got[2]["n"] == 5000 and math.isnan(got[2]["yy"])  # an infinite value spoils its own pair only
    assert T.moments(df.where("a < 0"), pairs).collect() == []


@pytest.mark.parametrize("listed, heavy", [(100_000, 100_000), (2, 100_000), (2, 30)])
def test_ranks_are_the_same_whether_broadcast_or_looked_up(spark, monkeypatch, listed, heavy):
    from terrasheaf import runtime

    monkeypatch.setattr(T, "LISTED", listed)
    monkeypatch.setattr(runtime, "HEAVY_ROWS", heavy)
    rng = np.random.default_rng(4)
    pdf = pd.DataFrame({"unscaled_yield": rng.integers(0, 200, 400).astype(float), "p": rng.normal(size=400), "q": rng.integers(0, 3, 400).astype(float), "z": np.zeros(400)})
    pdf.loc[rng.random(400) < 0.5, "p"] = 0.0  # heavy
    pdf.loc[rng.random(400) < 0.3, "p"] = None
    pdf.loc[rng.random(400) < 0.2, "q"] = None
    pdf.loc[rng.random(400) < 0.1, "unscaled_yield"] = None
    df = spark.createDataFrame(pdf.astype(object).where(pdf.notna(), None).values.tolist(), ", ".join(f"{c} double" for c in pdf)).repartition(5)
    for r in T.pairwise_corr(df, list(pdf)).collect():
        full = pdf[[r["a"], r["b"]]].dropna()
        assert r["n"] == len(full)
        if "z" in (r["a"], r["b"]):
            assert r["pearson_r"] is None and r["spearman_r"] is None
            continue
        assert r["pearson_r"] == pytest.approx(full.corr().iloc[0, 1], abs=1e-12)
        assert r["spearman_r"] == pytest.approx(full.rank().corr().iloc[0, 1], abs=1e-12)
    got = {r["predictor"]: r for r in T.yield_bivariate(df, ["p", "q", "z"]).collect()}
    assert set(got) == {"p", "q", "z"} and got["z"]["slope"] is None and got["z"]["pearson_p"] is None
    for c in "pq":
        full = pdf[[c, "unscaled_yield"]].dropna()
        slope, intercept = np.polyfit(full[c], full["unscaled_yield"], 1)
        assert (got[c]["slope"], got[c]["intercept"]) == pytest.approx((slope, intercept))
        assert got[c]["spearman_r"] == pytest.approx(full.rank().corr().iloc[0, 1], abs=1e-12)
        cut = np.quantile(full[c], [0.25, 0.75])
        ends = [full["unscaled_yield"][m].mean() for m in (full[c] <= cut[0], full[c] >= cut[1])]
        assert [got[c]["low_mean"], got[c]["high_mean"]] == pytest.approx(ends)
