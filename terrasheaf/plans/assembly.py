"""Queries: covariate assembly, soil, neighbourhoods and model preparation."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from terrasheaf.functions import keys as K
from terrasheaf.operators import covariates as C
from terrasheaf.operators import neighborhood as N
from terrasheaf.operators import quality as Q
from terrasheaf.operators import soil as S
from terrasheaf.plans.registry import query
from terrasheaf.plans.standins import Tables
from terrasheaf.runtime import scratch_path, stored

REQUIRED = ["unscaled_yield", "annual_tillage", "NCCPI", "vpdmax_7", "vpdmax_8"]
COVARIATES = ["annual_tillage", "NCCPI", "vpdmax_7", "vpdmax_8"]


def joined(t: Tables) -> DataFrame:
    return C.covariate_join(t.corn.select("tile_field_ID", "year", "unscaled_yield"), t.tillage, t.vpd, t.soil, t.county)


def model(t: Tables) -> DataFrame:
    """The joined rows that have all required values; stored, as neighbourhoods use them several times."""
    if "__model" not in t._made:
        t._made["__model"] = stored(C.required_values(joined(t), REQUIRED), "model")
    return t._made["__model"]


def edges(t: Tables) -> DataFrame:
    return N.distinct_edges(t.adjacency)


def hood(t: Tables) -> DataFrame:
    return N.neighborhood_expand(model(t), edges(t))


def rounded(df: DataFrame, digits: int = 6) -> DataFrame:
    """Doubles rounded, since their sums depend on the order of addition."""
    return df.select(*(F.round(c, digits).alias(c) if kind == "double" else F.col(c) for c, kind in df.dtypes))


@query("SELECT * FROM {joined}")
def D1_covariate_join(t: Tables) -> DataFrame:
    return joined(t)


@query("SELECT * FROM {joined}")
def D1_copartitioned_join(t: Tables) -> DataFrame:
    """The same from tables that lie in buckets of the field."""
    t.keep_by("tile_field_ID", "corn", "tillage", "vpd", "soil", "county")
    return C.copartitioned_join(t.corn.select("tile_field_ID", "year", "unscaled_yield"), t.tillage, t.vpd, t.soil, t.county)


@query("""SELECT count(*) AS corn_rows, count(*) FILTER (WHERE t IS NULL) AS missing_tillage, count(*) FILTER (WHERE t IS NOT NULL AND v IS NULL) AS missing_vpd,
count(*) FILTER (WHERE t IS NOT NULL AND v IS NOT NULL AND s IS NULL) AS missing_soil, count(*) FILTER (WHERE t IS NOT NULL AND v IS NOT NULL AND s IS NOT NULL AND k IS NULL) AS missing_county,
count(*) FILTER (WHERE t IS NOT NULL AND v IS NOT NULL AND s IS NOT NULL AND k IS NOT NULL) AS joined_rows
FROM (SELECT c.year, t.tile_field_ID AS t, v.tile_field_ID AS v, s.tile_field_ID AS s, k.tile_field_ID AS k FROM {corn} c LEFT JOIN {tillage} t ON c.tile_field_ID = t.tile_field_ID AND c.year = t.year
LEFT JOIN {vpd} v ON c.tile_field_ID = v.tile_field_ID AND c.year = v.year LEFT JOIN {soil} s ON c.tile_field_ID = s.tile_field_ID LEFT JOIN {county} k ON c.tile_field_ID = k.tile_field_ID)""")
def D2_coverage_funnel(t: Tables) -> DataFrame:
    return C.coverage_funnel(t.corn, t.tillage, t.vpd, t.soil, t.county)


@query("""SELECT coalesce(c.tile_field_ID, t.tile_field_ID, s.tile_field_ID) AS tile_field_ID, coalesce(c.year, t.year, s.year) AS year, unscaled_yield, annual_tillage, soy
FROM {corn} c FULL JOIN {tillage} t ON c.tile_field_ID = t.tile_field_ID AND c.year = t.year
FULL JOIN (SELECT tile_field_ID, year, max(vpdmax_7) AS soy FROM {vpd} GROUP BY tile_field_ID, year) s ON coalesce(c.tile_field_ID, t.tile_field_ID) = s.tile_field_ID AND coalesce(c.year, t.year) = s.year""")
def D3_merge_field_year(t: Tables) -> DataFrame:
    soy = t.vpd.select("tile_field_ID", "year", F.col("vpdmax_7").alias("soy"))
    return C.merge_field_year(t.corn.select("tile_field_ID", "year", "unscaled_yield"), t.tillage.select("tile_field_ID", "year", "annual_tillage"), soy)


@query("SELECT m.mukey, m.tile_field_id, overlap_area, nccpi3all FROM {field_mukey} m JOIN {valu1} v ON m.mukey = v.mukey")
def D4_mukey_lookup(t: Tables) -> DataFrame:
    return S.mukey_lookup(t.field_mukey.select("mukey", "tile_field_id", "overlap_area"), t.valu1.select("mukey", "nccpi3all"))


@query("SELECT count(*) AS unmatched_rows, count(DISTINCT m.mukey) AS unmatched_mukeys FROM {field_mukey} m WHERE m.mukey NOT IN (SELECT mukey FROM {valu1})")
def D4_unmatched_mukeys(t: Tables) -> DataFrame:
    return S.unmatched_mukeys(t.field_mukey, t.valu1)


@query("SELECT focal_fips, tile_field_ID, year, unscaled_yield, FIPS FROM {hood}")
def D5_neighborhood_expand(t: Tables) -> DataFrame:
    return hood(t).select("focal_fips", "tile_field_ID", "year", "unscaled_yield", "FIPS")


@query(
    "SELECT focal_fips, count(*) AS rows FROM (SELECT focal_fips, m.tile_field_ID FROM {model} m JOIN (SELECT focal_fips, neighbor_fips FROM {edges} "
    "WHERE focal_fips IN (SELECT focal_fips FROM {focal}) UNION SELECT focal_fips, focal_fips FROM {focal}) e ON m.FIPS = e.neighbor_fips) GROUP BY 1"
)
def D5_with_self(t: Tables) -> DataFrame:
    return N.neighborhood_expand(model(t), edges(t), include_self=True).groupBy("focal_fips").agg(F.count(F.lit(1)).alias("rows"))


MANIFEST = """SELECT f.focal_fips, e.neighbor_count, coalesce(h.row_count, 0) AS row_count, h.year_min, h.year_max, coalesce(o.joined_row_count, 0) AS joined_row_count, c.corn_rows, c.tillage_rows FROM {focal} f
LEFT JOIN (SELECT focal_fips, count(*) AS neighbor_count FROM {edges} GROUP BY 1) e ON f.focal_fips = e.focal_fips
LEFT JOIN (SELECT focal_fips, count(*) AS row_count, min(year) AS year_min, max(year) AS year_max FROM {hood} GROUP BY 1) h ON f.focal_fips = h.focal_fips
LEFT JOIN (SELECT FIPS, count(*) AS joined_row_count FROM {model} GROUP BY 1) o ON f.focal_fips = o.FIPS
CROSS JOIN (SELECT (SELECT count(*) FROM {corn}) AS corn_rows, (SELECT count(*) FROM {tillage}) AS tillage_rows) c"""


def manifest(t: Tables) -> DataFrame:
    counts = t.corn.agg(F.count(F.lit(1)).alias("corn_rows")).crossJoin(t.tillage.agg(F.count(F.lit(1)).alias("tillage_rows")))
    return N.neighborhood_manifest(C.required_values(joined(t), REQUIRED), edges(t), counts)  # which reads its rows once


@query(MANIFEST)
def E22_neighborhood_manifest(t: Tables) -> DataFrame:
    return manifest(t)


@query(
    "SELECT focal_fips, neighbor_count, corn_rows AS source_corn_rows, tillage_rows AS source_tillage_rows, joined_row_count, "
    f"row_count AS output_row_count, year_min, year_max FROM ({MANIFEST})"
)
def E23_neighborhood_diagnostics(t: Tables) -> DataFrame:
    return N.neighborhood_diagnostics(manifest(t), ["corn_rows", "tillage_rows"])


@query(f"SELECT h.focal_fips, h.tile_field_ID, h.year, m.row_count FROM {{hood}} h LEFT JOIN ({MANIFEST}) m ON h.focal_fips = m.focal_fips")
def D6_manifest_join(t: Tables) -> DataFrame:
    sizes = N.neighborhood_manifest(model(t), edges(t))  # of the rows that are stored for the neighbourhoods
    return N.manifest_join(hood(t).select("focal_fips", "tile_field_ID", "year"), sizes.select("focal_fips", "row_count"))


@query("SELECT tile_field_ID, year, unscaled_yield FROM {corn} WHERE year BETWEEN 1996 AND 1999")
def C1_year_range(t: Tables) -> DataFrame:
    return C.year_range(t.corn.select("tile_field_ID", "year", "unscaled_yield"), 1996, 1999)


@query(
    "SELECT tile_field_ID, year, annual_tillage, tillage_na_prop FROM (SELECT t.tile_field_ID, t.year, t.annual_tillage, w.tillage_na_prop "
    "FROM {tillage} t JOIN {tillage_wide} w ON t.tile_field_ID = w.tile_field_ID AND t.year = w.year) WHERE annual_tillage IS NOT NULL "
    "AND NOT tillage_na_prop > 0.3"
)
def C2_na_coverage(t: Tables) -> DataFrame:
    rows = t.tillage.select("tile_field_ID", "year", "annual_tillage").join(t.tillage_wide.select("tile_field_ID", "year", "tillage_na_prop"), ["tile_field_ID", "year"])
    return C.na_coverage(rows, ["tile_field_ID", "year"], "annual_tillage", "tillage_na_prop", 0.3)


@query("SELECT * FROM {model}")
def C3_required_values(t: Tables) -> DataFrame:
    return C.required_values(joined(t), REQUIRED)


@query(
    "SELECT count(*) AS rows, "
    "count(*) FILTER (WHERE annual_tillage IS NULL OR vpdmax_7 IS NULL OR vpdmax_8 IS NULL OR NCCPI IS NULL OR unscaled_yield IS NULL) AS dropped "
    "FROM {joined}"
)
def C3_dropped_rows(t: Tables) -> DataFrame:
    return C.dropped_rows(joined(t), REQUIRED)


@query("SELECT tile_field_ID, year, tillage_0_count FROM {tillage_wide} WHERE tile_field_ID IS NOT NULL AND year IS NOT NULL")
def C4_drop_incomplete_zonal(t: Tables) -> DataFrame:
    return C.required_values(t.tillage_wide.select("tile_field_ID", "year", "tillage_0_count"), ["tile_field_ID", "year"])


@query(
    "SELECT tile_field_id, mukey, overlap_area, nccpi3all, nccpi3corn FROM (SELECT m.*, v.nccpi3all, v.nccpi3corn FROM {field_mukey} m LEFT "
    "JOIN {valu1} v ON m.mukey = v.mukey) WHERE overlap_area > 0 AND (nccpi3all IS NOT NULL OR nccpi3corn IS NOT NULL)"
)
def C9_positive_weight(t: Tables) -> DataFrame:
    rows = t.field_mukey.join(t.valu1, "mukey", "left").select("tile_field_id", "mukey", "overlap_area", "nccpi3all", "nccpi3corn")
    return S.positive_weight(rows, "overlap_area", ["nccpi3all", "nccpi3corn"])


@query(
    "SELECT tile_field_ID, year, annual_tillage, NCCPI, vpdmax_7, vpdmax_8 FROM {joined} WHERE annual_tillage IS NOT NULL AND NCCPI IS NOT NULL "
    "AND vpdmax_7 IS NOT NULL AND vpdmax_8 IS NOT NULL"
)
def C11_drop_na_model(t: Tables) -> DataFrame:
    return N.complete_cases(joined(t), COVARIATES).select("tile_field_ID", "year", *COVARIATES)


SOIL = ", ".join(f"round(sum(CASE WHEN {v} IS NOT NULL THEN overlap_area * {v} END) / sum(CASE WHEN {v} IS NOT NULL THEN overlap_area END), 6) AS {v}" for v in ("nccpi3all", "nccpi3corn", "nccpi3soy"))


@query(f"SELECT m.tile_field_id, {SOIL} FROM {{field_mukey}} m JOIN {{valu1}} v ON m.mukey = v.mukey GROUP BY 1")
def E4_weighted_nccpi(t: Tables) -> DataFrame:
    return S.weighted_means(S.mukey_lookup(t.field_mukey, t.valu1), "tile_field_id", "overlap_area", S.VALUES)


@query(
    "SELECT tile_field_id, string_agg(CAST(mukey AS VARCHAR), ',' ORDER BY mukey) AS mukeys, sum(overlap_area) AS area, count(*) AS mukey_count "
    "FROM {field_mukey} GROUP BY 1"
)
def B23_nest_by_field(t: Tables) -> DataFrame:
    rows = S.nest_by_field(t.field_mukey, "tile_field_id", "mukey", "cells", "overlap_area")
    area = F.aggregate(F.map_values("area_by_mukey"), F.lit(0.0), lambda a, x: a + x)
    return rows.select("tile_field_id", F.array_join(F.col("mukeys").cast("array<string>"), ",").alias("mukeys"), area.alias("area"), "mukey_count")


@query(
    "SELECT tile_field_id, mukey, overlap_area FROM (SELECT *, row_number() OVER (PARTITION BY tile_field_id ORDER BY overlap_area DESC, mukey) AS r "
    "FROM {field_mukey}) WHERE r = 1"
)
def F10_dominant_mukey(t: Tables) -> DataFrame:
    return S.dominant_mukey(t.field_mukey, "tile_field_id")


@query("SELECT 'IA' AS state_code, mukey, nccpi3all, nccpi3corn, nccpi3soy FROM {valu1} WHERE state_code = 'IA'")
def E36_valu1_extract(t: Tables) -> DataFrame:
    return S.valu1_extract(t.valu1.where("state_code = 'IA'"), "IA").select("state_code", "mukey", "nccpi3all", "nccpi3corn", "nccpi3soy")


@query("SELECT mukey, nccpi3soy, 2 AS repeats FROM {valu1}")
def I3_assert_consistent_lookup(t: Tables) -> DataFrame:
    return S.consistent_lookup(t.valu1.unionByName(t.valu1), "mukey", ["nccpi3soy"]).withColumn("repeats", F.col("repeats").cast("int"))


@query("SELECT tile_field_ID, CAST(year AS INT) AS year FROM {corn} UNION SELECT tile_field_ID, year FROM {tillage} UNION SELECT tile_field_ID, year FROM {vpd}")
def S2_key_union(t: Tables) -> DataFrame:
    return C.key_union([t.corn, t.tillage, t.vpd], ["tile_field_ID", "year"])


@query("SELECT focal_fips FROM {focal}")
def S3_focal_set(t: Tables) -> DataFrame:
    return N.focal_set(model(t), edges(t))


@query("SELECT focal_fips, neighbor_fips FROM {edges}")
def S4_distinct_edges(t: Tables) -> DataFrame:
    return N.distinct_edges(t.adjacency.unionByName(t.adjacency))


@query(
    "SELECT field_id, day, vpdmax_mean, line FROM (SELECT *, row_number() OVER (PARTITION BY tile_coord, field_id, day ORDER BY source DESC, "
    "line DESC) AS r FROM {monthly}) WHERE r = 1"
)
def F7_last_write_wins(t: Tables) -> DataFrame:
    return C.last_write_wins(t.monthly.select("tile_coord", "field_id", "day", "vpdmax_mean", "source", "line"), ["tile_coord", "field_id", "day"], ["source", "line"]).select("field_id", "day", "vpdmax_mean", "line")


@query(
    "SELECT i.tile_field_ID, c.year, c.unscaled_yield, s.NCCPI, v.vpdmax_7 FROM {keys} i LEFT JOIN {corn} c ON i.tile_field_ID = c.tile_field_ID LEFT "
    "JOIN {soil} s ON i.tile_field_ID = s.tile_field_ID LEFT JOIN {vpd} v ON i.tile_field_ID = v.tile_field_ID AND c.year = v.year"
)
def E39_field_covariates(t: Tables) -> DataFrame:
    rows = C.field_covariates(t.keys.select("tile_field_ID"), t.corn.select("tile_field_ID", "year", "unscaled_yield"), t.soil, t.vpd)
    return rows.select("tile_field_ID", "year", "unscaled_yield", "NCCPI", "vpdmax_7")


@query("SELECT tile_field_ID, year, annual_tillage FROM {tillage}")
def B11_dominant_tillage(t: Tables) -> DataFrame:
    c = {n: F.col(f"tillage_{n}") for n in ("0_prop", "1_prop", "0_count", "1_count")}
    return t.tillage_wide.select("tile_field_ID", "year", K.dominant_tillage(c["0_prop"], c["1_prop"], c["0_count"], c["1_count"]).alias("annual_tillage"))


@query(
    "SELECT tile_field_ID, year, round(CASE WHEN tillage_0_prop + tillage_1_prop > 0 THEN tillage_1_prop / (tillage_0_prop + tillage_1_prop) END, "
    "9) AS tillage_prop_01 FROM {tillage}"
)
def B12_tillage_prop_01(t: Tables) -> DataFrame:
    return rounded(t.tillage.select("tile_field_ID", "year", K.tillage_prop_01(F.col("tillage_0_prop"), F.col("tillage_1_prop")).alias("tillage_prop_01")), 9)


STATS = ", ".join(f"avg({c}) AS m_{c}, stddev_samp({c}) AS s_{c}" for c in COVARIATES)


@query("SELECT focal_fips, covariate, round(avg(value), 6) AS mean, round(stddev_samp(value), 6) AS sd FROM (" + " UNION ALL ".join(f"SELECT focal_fips, '{c}' AS covariate, CAST({c} AS DOUBLE) AS value FROM {{hood}}" for c in COVARIATES) + ") GROUP BY 1, 2 UNION ALL SELECT DISTINCT focal_fips, 'year', CAST(0 AS DOUBLE), CAST(1 AS DOUBLE) FROM {hood}")
def E28_scaling_factors(t: Tables) -> DataFrame:
    return rounded(N.scaling_factors(hood(t), COVARIATES))


@query(
    "SELECT focal_fips, 'NCCPI' AS term, round(3.0 * stddev_samp(NCCPI), 6) AS prior_mean, round(abs(3.0 * stddev_samp(NCCPI)), 6) AS prior_sd FROM {hood} "
    "GROUP BY 1 UNION ALL SELECT focal_fips, 'vpdmax_7', round(-0.5 * stddev_samp(vpdmax_7), 6), round(abs(-0.5 * stddev_samp(vpdmax_7)), 6) FROM {hood} "
    "GROUP BY 1 UNION ALL SELECT DISTINCT focal_fips, 'Intercept', CAST(2250 AS DOUBLE), CAST(500 AS DOUBLE) FROM {hood}"
)
def E29_prior_table(t: Tables) -> DataFrame:
    effects = t.spark.createDataFrame([("NCCPI", 3.0), ("vpdmax_7", -0.5)], "covariate string, effect double")
    return rounded(N.prior_table(N.scaling_factors(hood(t), COVARIATES), effects))


@query(
    "SELECT FIPS, CAST(sum(n) AS BIGINT) AS n, round(max(CASE WHEN year <> 1998 THEN vpd END), 6) AS max_vpd FROM (SELECT FIPS, year, count(*) AS n, "
    "avg(vpdmax_7) AS vpd FROM {joined} WHERE state IN ('S0', 'S1', 'S2') GROUP BY 1, 2) GROUP BY 1 HAVING sum(n) >= 20 AND max(CASE "
    "WHEN year <> 1998 THEN vpd END) > 21"
)
def E32_target_counties(t: Tables) -> DataFrame:
    return rounded(N.target_counties(joined(t), 20, ["S0", "S1", "S2"], 21, 1998))


@query(
    "SELECT focal_fips, tile_field_ID, year, round(avg(annual_tillage) OVER (PARTITION BY focal_fips, tile_field_ID), 6) AS annual_tillage_mean, "
    "round(annual_tillage - avg(annual_tillage) OVER (PARTITION BY focal_fips, tile_field_ID), 6) AS annual_tillage_within FROM {hood}"
)
def F6_mean_within(t: Tables) -> DataFrame:
    rows = N.mean_within(hood(t).select("focal_fips", "tile_field_ID", "year", "annual_tillage"), "annual_tillage", ["focal_fips", "tile_field_ID"])
    return rounded(rows.drop("annual_tillage"))


def z(c: str) -> str:
    return f"(h.{c} - m_{c}) / nullif(s_{c}, 0)"


@query(
    f"SELECT h.focal_fips, h.tile_field_ID, h.year, h.year - 2010 AS year_c, round({z('NCCPI')}, 6) AS z_NCCPI, "
    f"round({z('annual_tillage')} * ({z('vpdmax_7')}), 6) AS z_annual_tillage_x_vpdmax_7 FROM {{hood}} h JOIN (SELECT focal_fips, {STATS} FROM {{hood}} "
    "GROUP BY 1) s ON h.focal_fips = s.focal_fips"
)
def F8_design_matrix(t: Tables) -> DataFrame:
    return rounded(N.design_matrix(hood(t), COVARIATES).select("focal_fips", "tile_field_ID", "year", "year_c", "z_NCCPI", "z_annual_tillage_x_vpdmax_7"))


def ols_sql(rows: str, xs: list[str], digits: int) -> str:
    """Least squares by orthogonal steps: each variable, less its group's mean, is freed of those before it and taken out of those after it;
    the estimates follow from the last variable back to the first."""
    names = [*xs, "y"]
    steps = [f"s0 AS (SELECT *, " + ", ".join(f"{c} - avg({c}) OVER g AS c0_{c}" for c in names) + ", " + ", ".join(f"avg({c}) OVER g AS m_{c}" for c in names) + f" FROM ({rows}) WINDOW g AS (PARTITION BY focal_fips))"]
    for k, x in enumerate(xs):
        later = names[k + 1 :]
        steps.append(f"a{k} AS (SELECT *, " + ", ".join(f"sum(c{k}_{c} * c{k}_{x}) OVER g / nullif(sum(c{k}_{x} * c{k}_{x}) OVER g, 0) AS b{k}_{c}" for c in later) + f" FROM s{k} WINDOW g AS (PARTITION BY focal_fips))")
        steps.append(f"s{k + 1} AS (SELECT *, " + ", ".join(f"c{k}_{c} - b{k}_{c} * c{k}_{x} AS c{k + 1}_{c}" for c in later) + f" FROM a{k})")
    p = len(xs)
    beta: dict[str, str] = {}
    for k in range(p - 1, -1, -1):
        beta[xs[k]] = "(" + " - ".join([f"max(b{k}_y)", *(f"{beta[xs[j]]} * max(b{k}_{xs[j]})" for j in range(k + 1, p))]) + ")"
    start = " - ".join(["max(m_y)", *(f"{beta[x]} * max(m_{x})" for x in xs)])
    terms = [("1", start), *beta.items()]
    return (
        f"WITH {', '.join(steps)} SELECT focal_fips, n, unnest([{', '.join(repr(t) for t, _ in terms)}]) AS term, "
        f"unnest([{', '.join(f'round(e{i}, {digits})' for i in range(len(terms)))}]) AS estimate FROM (SELECT focal_fips, "
        f"count(*) AS n, {', '.join(f'{e} AS e{i}' for i, (_, e) in enumerate(terms))} FROM s{p} GROUP BY 1)"
    )


SCALED = ["z_annual_tillage", "z_NCCPI", "z_vpdmax_7", "year_c"]
DESIGN = (
    f"SELECT h.focal_fips, unscaled_yield AS y, {', '.join(f'{z(c)} AS z_{c}' for c in ('annual_tillage', 'NCCPI', 'vpdmax_7'))}, "
    f"CAST(h.year - 2010 AS DOUBLE) AS year_c FROM {{hood}} h JOIN (SELECT focal_fips, {STATS} FROM {{hood}} GROUP BY 1) s ON h.focal_fips = s.focal_fips"
)


@query("SELECT * FROM (" + ols_sql(f"SELECT * FROM ({DESIGN}) WHERE z_annual_tillage IS NOT NULL AND z_NCCPI IS NOT NULL AND z_vpdmax_7 IS NOT NULL", SCALED, 3) + ")")
def E37_neighborhood_ols(t: Tables) -> DataFrame:
    return rounded(N.neighborhood_ols(N.design_matrix(hood(t), COVARIATES), "unscaled_yield", SCALED), 3)


@query("SELECT * FROM (" + ols_sql("SELECT focal_fips, unscaled_yield AS y, CAST(annual_tillage AS DOUBLE) AS annual_tillage, NCCPI FROM {hood}", ["annual_tillage", "NCCPI"], 0) + ")")
def J2_solve_normal(t: Tables) -> DataFrame:
    return rounded(N.neighborhood_ols(hood(t), "unscaled_yield", ["annual_tillage", "NCCPI"]), 0)


@query(
    "SELECT fit, variable, round(avg(value), 6) AS mean, round(stddev_samp(value), 6) AS sd, round(quantile_cont(value, 0.05), 6) AS q5, "
    "round(quantile_cont(value, 0.95), 6) AS q95 FROM {draws} GROUP BY 1, 2"
)
def E30_draws_summary(t: Tables) -> DataFrame:
    return rounded(N.draws_summary(t.draws))


@query(
    "SELECT variable AS fips, max(iteration) AS completed_iter, max(iteration) + chain_max AS target_iter, CASE WHEN max(iteration) = 0 THEN 'pending' "
    "WHEN chain_max > 0 THEN 'needs_more' ELSE 'complete' END AS status FROM (SELECT concat(fit, '-', variable, '-', CAST(chain AS STRING)) AS variable, "
    "iteration, max(chain) OVER (PARTITION BY fit, variable, chain) AS chain_max FROM {draws}) GROUP BY variable, chain_max"
)
def E31_fit_manifest(t: Tables) -> DataFrame:
    name = F.concat_ws("-", "fit", "variable", F.col("chain").cast("string"))
    last = t.draws.groupBy(name.alias("fips"), "chain").agg(F.max("iteration").alias("completed_iter"))
    path = scratch_path(t.spark, "fit-states")
    last.select("fips", "completed_iter", (F.col("completed_iter") + F.col("chain")).alias("target_iter")).write.json(path)
    return N.fit_manifest(N.read_states(t.spark, path))


@query(
    "SELECT count(*) AS rows, count(*) FILTER (WHERE annual_tillage IS NULL) AS tie_or_missing, count(*) FILTER (WHERE tillage_0_prop > 0.5) AS mostly_0 "
    "FROM {tillage}"
)
def E24_job_summary(t: Tables) -> DataFrame:
    return Q.job_summary(t.tillage, {"tie_or_missing": F.col("annual_tillage").isNull(), "mostly_0": F.col("tillage_0_prop") > 0.5})


@query("SELECT CAST(sum(n0) AS BIGINT) AS n0, CAST(sum(n1) AS BIGINT) AS n1, string_agg(DISTINCT tile_coord, ';' ORDER BY tile_coord) AS tiles FROM {tillage_counts}")
def E25_rollup_summaries(t: Tables) -> DataFrame:
    per_tile = t.tillage_counts.groupBy(F.col("tile_coord").alias("tile")).agg(F.sum("n0").alias("n0"), F.sum("n1").alias("n1"))
    path = scratch_path(t.spark, "tile-summaries")
    per_tile.write.json(path)
    return Q.rollup_summaries(Q.read_summaries(t.spark, path, ["n0", "n1"]), ["n0", "n1"])


@query("SELECT count(*) AS rows, CAST(count(*) - count(DISTINCT (tile_field_ID, year)) AS BIGINT) AS duplicate_rows FROM {hood}")
def F9_duplicate_rows(t: Tables) -> DataFrame:
    return Q.duplicate_rows(hood(t), ["tile_field_ID", "year"])


@query(
    "SELECT 'annual_tillage' AS column_name, count(*) FILTER (WHERE annual_tillage IS NULL) AS missing FROM {joined} UNION ALL SELECT 'vpdmax_7', "
    "count(*) FILTER (WHERE vpdmax_7 IS NULL) FROM {joined} UNION ALL SELECT 'vpdmax_8', count(*) FILTER (WHERE vpdmax_8 IS NULL) FROM {joined} UNION ALL "
    "SELECT 'county', count(*) FILTER (WHERE county IS NULL) FROM {joined}"
)
def I9_optional_missing(t: Tables) -> DataFrame:
    return Q.optional_missing(joined(t), ["annual_tillage", "vpdmax_7", "vpdmax_8", "county"])


@query("SELECT tile_field_ID, year, unscaled_yield FROM {corn}")
def I2_assert_unique(t: Tables) -> DataFrame:
    return Q.unique_or_error(t.corn, ["tile_field_ID", "year"]).select("tile_field_ID", "year", "unscaled_yield")


@query("""SELECT e.year, coalesce(rows, 0) AS rows, coalesce(duplicate_keys, 0) AS duplicate_keys, coalesce(missing, 0) AS missing, coalesce(out_of_range, 0) AS out_of_range, coalesce(rows, 0) > 0 AS present FROM (SELECT CAST(y AS INT) AS year FROM range(1994, 2003) r(y)) e
LEFT JOIN (SELECT year, CAST(sum(n) AS BIGINT) AS rows, count(*) FILTER (WHERE n > 1) AS duplicate_keys, CAST(sum(m) AS BIGINT) AS missing, CAST(sum(o) AS BIGINT) AS out_of_range FROM (SELECT year, tile_field_ID, count(*) AS n, count(*) FILTER (WHERE annual_tillage IS NULL) AS m, count(*) FILTER (WHERE annual_tillage > 0) AS o FROM {hood} GROUP BY 1, 2) GROUP BY 1) h ON e.year = h.year""")
def I7_coverage_qc(t: Tables) -> DataFrame:
    expected = t.spark.range(1994, 2003).select(F.col("id").cast("int").alias("year"))
    return Q.coverage_qc(hood(t), expected, ["tile_field_ID", "year"], "annual_tillage", 0, 0)
