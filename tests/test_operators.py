"""Golden fixtures, numerical cross-checks and the semantics that are easy to get wrong."""

from __future__ import annotations

import uuid

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from terrasheaf.functions import geometry as G
from terrasheaf.functions import keys as K
from terrasheaf.operators import covariates as C
from terrasheaf.operators import cropyear as Y
from terrasheaf.operators import grid as R
from terrasheaf.operators import neighborhood as N
from terrasheaf.operators import quality as Q
from terrasheaf.operators import soil as S
from terrasheaf.operators import spatial as P
from terrasheaf.operators import stats as T
from terrasheaf.operators import zonal as Z
from terrasheaf.sources import tables as R2


def one(spark, **columns):
    return spark.range(1).select(*(F.lit(v).alias(n) if not hasattr(v, "_jc") else v.alias(n) for n, v in columns.items())).first()


def test_golden_tillage_row(spark, tmp_path):
    (tmp_path / "in.csv").write_text("﻿tile_coord,field_id,year,tillage_0_count,tillage_1_count,tillage_na_count,tillage_0_prop,tillage_1_prop,tillage_na_prop,pixel_count\nh18v05,123,2016,2,1,1,0.5,0.25,0.25,4\n", encoding="utf-8")
    df = R2.read_text_table(spark, str(tmp_path / "in.csv"), ["tile_coord", "year"])
    num = {c: K.to_number(F.col(c)) for c in ("tillage_0_prop", "tillage_1_prop", "tillage_0_count", "tillage_1_count")}
    r = df.select(K.tile_field_id([F.lit(None).cast("string")], [F.col("tile_coord")], [F.col("field_id")]).alias("id"), K.dominant_tillage(*num.values()).alias("d")).first()
    assert (r["id"], r["d"]) == ("h18v05_123", 0)
    with pytest.raises(ValueError, match="nope"):
        R2.read_text_table(spark, str(tmp_path / "in.csv"), ["nope"])


FIELDS, CROPS = [[1, 1, 2], [1, 2, 2], [3, 3, 3]], [[5, 5, 1], [5, 1, 1], [2, 2, 4]]


def pixels(spark, rows):
    return spark.createDataFrame([("t", r, c, v) for r, row in enumerate(rows) for c, v in enumerate(row)], "tile string, row int, col int, value long")


def test_golden_pair_counts_and_summary(spark):
    counts = Y.pair_counts(pixels(spark, FIELDS), pixels(spark, CROPS), F.lit(2010))
    assert sorted((r["field_id"], r["crop_id"], r["pixel_count"]) for r in counts.collect()) == [(1, 5, 3), (2, 1, 3), (3, 2, 2), (3, 4, 1)]
    rows = {(r["field_id"], r["crop_id"]): r for r in Y.crop_year_summary(counts).collect()}
    assert rows[3, 4]["share"] == pytest.approx(1 / 3) and not rows[3, 4]["is_dominant"] and rows[3, 4]["dominant_crop_id"] == 2
    summary = Y.crop_year_summary(counts)
    checks = Y.validate_crop_year(counts, summary, 2010).first().asDict()
    assert len(checks) == 10 and all(checks.values())
    assert [k for k, ok in Y.validate_crop_year(counts, summary.where("crop_id <> 4"), 2010).first().asDict().items() if not ok] == ["shares_sum_to_one", "rows_match"]
    tie = spark.createDataFrame([(1, 2010, 9, 5), (1, 2010, 4, 5)], "field_id long, year int, crop_id long, pixel_count long")
    assert {r["dominant_crop_id"] for r in Y.crop_year_summary(tie).collect()} == {4}


def test_unaligned_grids_are_refused(spark):
    grid = spark.createDataFrame([("t", 0.0, 0.0, 1.0, 1.0, 3, 3, "c", 0)], "tile string, x0 double, y0 double, dx double, dy double, ncols int, nrows int, crs string, nodata long")
    with pytest.raises(ValueError, match="not aligned"):
        R.pixel_pair_join(pixels(spark, FIELDS), pixels(spark, CROPS), grid, grid.withColumn("x0", F.lit(0.5)))


def test_burn_form_lets_the_last_ring_win(spark):
    grid = spark.createDataFrame([("t", 0.0, 0.0, 1.0, 1.0, 4, 4, "c", 0)], "tile string, x0 double, y0 double, dx double, dy double, ncols int, nrows int, crs string, nodata long")
    square = lambda a, b: [(a, a), (b, a), (b, b), (a, b), (a, a)]
    rings = spark.createDataFrame([("t", 1, square(0.0, 3.0)), ("t", 2, square(1.0, 4.0))], "tile string, id int, ring array<struct<x double, y double>>")
    assert R.rasterize(rings, grid, ["id"]).count() == 18
    burned = R.rasterize(rings, grid, ["id"], "burn", "id").groupBy("id").count().collect()
    assert {r["id"]: r["count"] for r in burned} == {1: 5, 2: 9}


def test_uuid5_equals_python(spark):
    name = "src|h18v05|123"
    r = one(spark, a=K.uuid5(K.FIELD_NAMESPACE, F.lit(name)))
    assert r["a"] == str(uuid.uuid5(uuid.UUID(K.FIELD_NAMESPACE), name)) == "0b71eb4d-390a-5876-b52b-11befbf1380f"


def test_albers_known_point_and_round_trip(spark):
    x, y = G.reproject_xy(F.lit(-96.0), F.lit(23.0), 4326, 5070)
    r = one(spark, x=x, y=y)
    assert abs(r["x"]) < 1e-6 and abs(r["y"]) < 1e-6
    for lon, lat in ((-120.5, 48.2), (-75.0, 26.5), (-96.0, 37.5)):
        back = G.reproject_xy(*G.reproject_xy(F.lit(lon), F.lit(lat), 4326, 5070), 5070, 3857)
        direct = G.reproject_xy(F.lit(lon), F.lit(lat), 4326, 3857)
        r = one(spark, a=back[0], b=back[1], c=direct[0], d=direct[1])
        assert (r["a"], r["b"]) == (pytest.approx(r["c"], abs=0.01), pytest.approx(r["d"], abs=0.01))


def test_lenient_and_strict_numbers(spark):
    r = one(spark, a=K.to_number(F.lit("x")), b=K.to_number(F.lit("nan")), c=K.to_number(F.lit(" 2.5 ")))
    assert (r["a"], r["b"], r["c"]) == (None, None, 2.5)
    with pytest.raises(Exception, match="not a number"):
        one(spark, a=K.to_number(F.lit("x"), strict=True))
    with pytest.raises(Exception, match="tillage must be"):
        one(spark, a=K.annual_tillage(F.lit("2")))


def test_dominant_tillage_does_not_fall_through_on_ties(spark):
    lit = lambda *v: [F.lit(x).cast("double") for x in v]
    r = one(spark, tie=K.dominant_tillage(*lit(0.5, 0.5, 1, 9)), counts=K.dominant_tillage(*lit(None, 0.5, 1, 9)), none=K.dominant_tillage(*lit(None, None, None, 9)))
    assert (r["tie"], r["counts"], r["none"]) == (None, 1, None)


def test_share_modes_differ_on_nulls(spark):
    p0, p1 = F.lit(None).cast("double"), F.lit(0.4)
    assert one(spark, a=K.tillage_shares(p0, p1)["high_share_among_classified"])["a"] == 1.0
    assert one(spark, a=K.tillage_shares(p0, p1, nulls_as_zero=False)["high_share_among_classified"])["a"] is None


def test_normalize_id_variants(spark):
    c = lambda v, k: one(spark, a=K.normalize_id(F.lit(v), k))["a"]
    assert [c("12.0", "text"), c("12.00", "strict"), c("1e3", "number"), c("NaN", "nan"), c("H01V02_7.0", "tile"), c("x", "number")] == ["12", "12", "1000", None, "h01v02_7", "x"]


def test_focal_county_is_not_its_own_neighbour_unless_listed(spark):
    rows = spark.createDataFrame([("f1", 1, "A"), ("f2", 1, "B"), ("f3", 1, "C")], "tile_field_ID string, year int, FIPS string")
    edges = spark.createDataFrame([("A", "B"), ("B", "B"), ("B", "A")], "focal_fips string, neighbor_fips string")
    got = sorted((r["focal_fips"], r["tile_field_ID"]) for r in N.neighborhood_expand(rows, edges).collect())
    assert got == [("A", "f2"), ("B", "f1"), ("B", "f2")]
    none = edges.where("focal_fips = 'Z'")
    assert sorted((r["focal_fips"], r["tile_field_ID"]) for r in N.neighborhood_expand(rows, none).collect()) == [("A", "f1"), ("B", "f2"), ("C", "f3")]


def test_weighted_means_have_their_own_denominators(spark):
    df = spark.createDataFrame([("a", 2.0, 1.0, None), ("a", 2.0, 3.0, 5.0), ("b", 1.0, None, None), ("c", -1.0, 4.0, 4.0)], "k string, w double, u double, v double")
    rows = {r["k"]: (r["u"], r["v"]) for r in S.weighted_means(df, "k", "w", ["u", "v"]).collect()}
    assert rows == {"a": (2.0, 5.0)}


def test_lookup_conflicts_and_duplicates_are_errors(spark):
    df = spark.createDataFrame([(1, 2.0), (1, 2.0), (2, 1.0)], "mukey long, v double")
    assert {r["mukey"]: r["repeats"] for r in S.consistent_lookup(df, "mukey", ["v"]).collect()} == {1: 2, 2: 1}
    with pytest.raises(Exception, match="conflicting values"):
        S.consistent_lookup(df.unionByName(spark.createDataFrame([(2, 9.0)], df.schema)), "mukey", ["v"]).collect()
    with pytest.raises(ValueError, match="duplicate key"):
        Q.assert_unique(df, ["mukey"])


def test_last_write_needs_an_explicit_order(spark):
    df = spark.createDataFrame([("k", 1, "old"), ("k", 2, "new")], "k string, seq int, v string")
    assert C.last_write_wins(df, ["k"], ["seq"]).first()["v"] == "new"


def frame(seed=0, n=400):
    rng = np.random.default_rng(seed)
    x = np.round(rng.normal(size=n), 1)
    return pd.DataFrame({"g": rng.integers(0, 3, n), "x": x, "y": np.round(2 * x + rng.normal(size=n), 2), "c": 1.0})


def test_quantiles_and_ranks_equal_numpy(spark):
    pdf = frame()
    df = spark.createDataFrame(pdf)
    got = {r["g"]: (r["a"], r["b"]) for r in T.quantiles(df, ["g"], "x", {"a": 0.05, "b": 0.5}).collect()}
    for g, part in pdf.groupby("g"):
        assert got[g] == pytest.approx((np.quantile(part["x"], 0.05), np.quantile(part["x"], 0.5)))
    ranks = {(r["g"], r["x"]): r["rank"] for r in T.avg_rank(df, "x", ["g"]).collect()}
    want = pdf.groupby("g")["x"].rank()
    assert all(ranks[g, x] == w for g, x, w in zip(pdf["g"], pdf["x"], want, strict=True))
    assert T.quantiles(df.where("g = 9"), [], "x", {"a": 0.5}).first()["a"] is None


def test_correlations_and_p_values(spark):
    pdf = frame(1)
    got = T.pairwise_corr(spark.createDataFrame(pdf), ["x", "y", "c"]).collect()
    rows = {(r["a"], r["b"]): r for r in got}
    assert rows["x", "y"]["pearson_r"] == pytest.approx(np.corrcoef(pdf["x"], pdf["y"])[0, 1])
    assert rows["x", "y"]["spearman_r"] == pytest.approx(np.corrcoef(pdf["x"].rank(), pdf["y"].rank())[0, 1])
    assert rows["x", "c"]["pearson_r"] is None
    # two-sided t probabilities from tables: t = 2.228 at 10 degrees of freedom is 5 %, t = 1.96 at many
    t, df = 2.228138852, 10
    assert T.p_value(t / (df + t * t) ** 0.5, df + 2) == pytest.approx(0.05, abs=1e-8)
    assert T.p_value(0.0, 30) == pytest.approx(1) and T.p_value(1.0, 5) == 0 and T.p_value(None, 5) is None


def test_binned_yield_equals_pandas(spark):
    pdf = frame(2).rename(columns={"y": "unscaled_yield"})
    got = T.binned_yield(spark.createDataFrame(pdf), ["x"], 10).orderBy("bin_order").collect()
    want = pdf.groupby(pd.qcut(pdf["x"], 10, duplicates="drop"), observed=True)["unscaled_yield"].agg(["size", "mean"])
    assert [r["n"] for r in got] == want["size"].tolist() and [r["y_mean"] for r in got] == pytest.approx(want["mean"].tolist())
    cut = pd.qcut(pdf["x"], 10, duplicates="drop")
    assert [r["bin_order"] for r in got] == list(range(1, len(want) + 1)) and [r["bin_high"] for r in got] == pytest.approx([i.right for i in want.index], abs=1e-3)
    assert cut.notna().all()
    several = pdf.assign(two=pdf["g"] % 2, annual_tillage=pdf["g"], few=np.arange(len(pdf)) % 4 * (np.arange(len(pdf)) % 3 > 0), none=np.nan)
    rows = T.binned_yield(spark.createDataFrame(several), ["x", "two", "annual_tillage", "few", "none"], 10).collect()
    orders = {p: sorted(r["bin_order"] for r in rows if r["predictor"] == p) for p in ("x", "two", "annual_tillage", "few", "none")}
    assert orders["two"] == [0, 1] and orders["annual_tillage"] == [0, 1, 2] and orders["x"] == [r["bin_order"] for r in got] and orders["none"] == []
    want = several.groupby(pd.qcut(several["few"], 4, duplicates="drop"), observed=True).size()
    assert sorted(r["n"] for r in rows if r["predictor"] == "few") == sorted(want.tolist()) and len(orders["few"]) == len(want)


def test_least_squares_equals_numpy(spark):
    pdf = frame(3).assign(focal_fips="A", z=lambda d: d["g"] * 1.0)
    got = {r["term"]: r["estimate"] for r in N.neighborhood_ols(spark.createDataFrame(pdf), "y", ["x", "z"]).collect()}
    want = np.linalg.lstsq(np.c_[np.ones(len(pdf)), pdf["x"], pdf["z"]], pdf["y"], rcond=None)[0]
    assert [got["1"], got["x"], got["z"]] == pytest.approx(want.tolist())


def test_signed_rows_in_a_grid_box(spark):
    r = one(spark, b=G.grid_bbox(*(F.lit(v) for v in (0.0, 100.0, 10.0, -10.0, 3, 4))))["b"]
    assert (r["minx"], r["miny"], r["maxx"], r["maxy"]) == (0, 60, 30, 100)


def test_latest_snapshot_of_nothing_is_empty(spark):
    files = spark.createDataFrame([], "path string, length long, modificationTime timestamp")
    assert R2.latest_snapshot(files).collect() == []


def test_zonal_golden_proportions(spark):
    rows = spark.createDataFrame([("a", v) for v in (0, 0, 1, None)], "k string, v int")
    r = Z.value_counts(rows, ["k"], F.col("v"), {"t0": 0, "t1": 1}).first()
    assert (r["t0_count"], r["t1_count"], r["na_count"], r["pixel_count"], r["t0_prop"], r["na_prop"]) == (2, 1, 1, 4, 0.5, 0.25)


@pytest.mark.parametrize("crowded", [10**9, 3])
def test_box_join_equals_all_pairs(spark, monkeypatch, crowded):
    monkeypatch.setattr(P, "CROWDED_BOXES", crowded)
    rng = np.random.default_rng(4)
    make = lambda n: [(i, float(x - 15), float(y), float(x - 15 + w * 9**k), float(y + h)) for i, (x, y, w, h, k) in enumerate(rng.integers(0, (30, 30, 30, 30, 3), (n, 5)))]
    a, b = make(40), [*make(50), (50, 3.0, 3.0, 3.0, 3.0), (51, -1e6, -1e6, 1e6, 1e6)]
    box = "minx double, miny double, maxx double, maxy double"
    got = P.bbox_intersect_join(spark.createDataFrame(a, f"box_id int, {box}"), spark.createDataFrame(b, f"feature_id int, {box}"), 7.0).collect()
    want = {(p[0], q[0]) for p in a for q in b if p[1] <= q[3] and q[1] <= p[3] and p[2] <= q[4] and q[2] <= p[4]}
    assert len(got) == len(want) and {tuple(r) for r in got} == want


def test_overlapping_globs_give_each_file_once(spark, tmp_path):
    for name in ("b.csv", "a.csv", "sub/c.csv", "sub/d.txt"):
        (tmp_path / name).parent.mkdir(exist_ok=True)
        (tmp_path / name).write_text("x\n1\n")
    found = R2.expand_globs(spark, f" {tmp_path}/b*; {tmp_path}, {tmp_path}/no*,{tmp_path}/*.csv;", "*.csv")
    assert [p.rsplit("/", 1)[1] for p in found] == ["b.csv", "a.csv", "c.csv"]


def test_boundary_ids_are_version_5_uuids_of_seven_parts(spark):


    names = ["src", "30m", "2008", "", "h01v02", "7", "abc"]
    df = spark.createDataFrame([tuple(n or None for n in names)], "a string, b string, c string, d string, e string, f string, g string")
    got = df.select(K.boundary_uuid(*(F.col(c) for c in "abcdefg")).alias("id")).first()["id"]
    assert got == str(uuid.uuid5(uuid.UUID(K.BOUNDARY_NAMESPACE), "|".join(names)))


def test_manifest_finds_changed_missing_and_unexpected_files(spark):
    files = spark.createDataFrame([("a", 3, bytearray(b"abc")), ("b", 1, bytearray(b"x")), ("d", 0, bytearray(b""))], "path string, length long, content binary")
    rows = spark.createDataFrame([("a",), ("a",), ("b",)], "path string")
    sent = Y.delivery_manifest(files, rows)
    assert {r["path"]: (r["rows"], r["bytes"]) for r in sent.collect()} == {"a": (2, 3), "b": (1, 1), "d": (0, 0)}
    changed = files.where("path <> 'd'").withColumn("content", F.when(F.col("path") == "b", F.lit("y").cast("binary")).otherwise(F.col("content"))).unionByName(files.where("path = 'd'").withColumn("path", F.lit("e")))
    assert {r["path"]: r["hash_matches"] for r in Y.delivery_manifest(changed, rows, sent).collect()} == {"a": True, "b": False, "d": False, "e": False}


def test_summaries_and_states_are_read_from_json(spark, tmp_path):
    (tmp_path / "s1.json").write_text('{"tile": "h01", "n": 3}\n')
    (tmp_path / "s2.json").write_text('{"tile": "h00", "n": 4}\n')
    assert tuple(Q.rollup_summaries(Q.read_summaries(spark, f"{tmp_path}/s*.json", ["n"]), ["n"]).first()) == (7, "h00;h01")
    for k, done in enumerate((None, 5, 9)):
        (tmp_path / f"f{k}.json").write_text(f'{{"fips": "0{k}", {f""""completed_iter": {done}, """ if done is not None else ""}"target_iter": 9}}\n')
    got = {r["fips"]: r["status"] for r in N.fit_manifest(N.read_states(spark, f"{tmp_path}/f*.json")).collect()}
    assert got == {"00": "pending", "01": "needs_more", "02": "complete"}
