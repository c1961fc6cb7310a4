"""Queries: exploratory statistics over the joined table and its neighbourhoods."""

from __future__ import annotations

from itertools import combinations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from terrasheaf.functions import keys as K
from terrasheaf.operators import stats as S
from terrasheaf.plans.assembly import hood, joined, rounded
from terrasheaf.plans.registry import query
from terrasheaf.plans.standins import Tables
from terrasheaf.runtime import stored

VARIABLES = [
    *("unscaled_yield", "annual_tillage", "NCCPI", "nccpi3corn", "vpdmax_7", "vpdmax_8", "tillage_0_prop", "tillage_1_prop", "tillage_na_prop"),
    *("classified_share", "high_share_among_classified", "low_share_among_classified", "year"),
]
PREDICTORS = VARIABLES[1:]


def rounded_shares(rows: DataFrame) -> DataFrame:
    """Rows with their shares, rounded so that equal ones are equal in any engine."""
    df = S.with_shares(rows)
    return df.withColumns({c: F.round(c, 9) for c in ("tillage_na_prop", "classified_share", "high_share_among_classified", "low_share_among_classified")})


def shares(t: Tables) -> DataFrame:
    return rounded_shares(joined(t))


def long_sql(columns: list[str], names: list[str], table: str = "{shares}") -> str:
    keep = "".join(f"{c}, " for c in columns)
    return " UNION ALL ".join(f"SELECT {keep}'{v}' AS variable, CAST({v} AS DOUBLE) AS value FROM {table}" for v in names)


@query("SELECT tile_field_ID, year, tillage_na_prop, classified_share, high_share_among_classified, low_share_among_classified FROM {shares}")
def B13_tillage_shares(t: Tables) -> DataFrame:
    return rounded(shares(t).select("tile_field_ID", "year", "tillage_na_prop", "classified_share", "high_share_among_classified", "low_share_among_classified"), 9)


QUANTILES = ", ".join(f"round(quantile_cont(value, {p}), 6) AS {n}" for n, p in S.PROFILE.items())


@query(
    "SELECT variable, count(*) AS rows, count(value) AS non_null, count(*) - count(value) AS missing, round((count(*) - count(value)) / count(*), "
    "6) AS missing_rate, count(DISTINCT value) AS distinct_values, round(avg(value), 6) AS mean, round(coalesce(stddev_samp(value), CASE WHEN "
    f"count(value) = 1 THEN 0 END), 6) AS std, min(value) AS min, max(value) AS max, {QUANTILES} FROM (SELECT variable, round(value, 6) AS value "
    f"FROM ({long_sql([], VARIABLES)})) GROUP BY 1"
)
def E14_numeric_profile(t: Tables) -> DataFrame:
    rows = shares(t).select(*(F.round(F.col(v).cast("double"), 6).alias(v) for v in VARIABLES))
    return rounded(S.numeric_profile(rows, VARIABLES))


def corr_sql(rows: str, keys: str, extra: str = "") -> str:
    """Pearson, Spearman and the line of (keys, x, y); guarded as the operator is."""
    ranked = f"SELECT *, rank() OVER (PARTITION BY {keys} ORDER BY x) + (count(*) OVER (PARTITION BY {keys}, x) - 1) / 2.0 AS rx, rank() OVER (PARTITION BY {keys} ORDER BY y) + (count(*) OVER (PARTITION BY {keys}, y) - 1) / 2.0 AS ry FROM ({rows}) WHERE x IS NOT NULL AND y IS NOT NULL"
    ok = "count(*) >= 3 AND min(x) < max(x) AND min(y) < max(y)"
    return (
        f"SELECT {keys}, count(*) AS n, CASE WHEN {ok} THEN corr(x, y) END AS r, CASE WHEN {ok} THEN corr(rx, ry) END AS s, CASE WHEN {ok} THEN regr_slope(y, "
        f"x) END AS b, CASE WHEN {ok} THEN regr_intercept(y, x) END AS a, avg(x) AS mx, avg(y) AS my{extra} FROM ({ranked}) GROUP BY {keys}"
    )


PAIRS = f"SELECT variable AS predictor, value AS x, unscaled_yield AS y FROM ({long_sql(['unscaled_yield'], PREDICTORS)})"


@query(
    "SELECT c.predictor, n, round(mx, 4) AS x_mean, round(my, 4) AS y_mean, round(r, 6) AS pearson_r, round(s, 6) AS spearman_r, round(b, 4) AS slope, "
    "round(a, 2) AS intercept, round(r * r, 6) AS r2, round(low_mean, 4) AS low_mean, round(high_mean, 4) AS high_mean "
    f"FROM ({corr_sql(PAIRS, 'predictor')}) c JOIN (SELECT p.predictor, avg(y) FILTER (WHERE x <= q25) AS low_mean, "
    f"avg(y) FILTER (WHERE x >= q75) AS high_mean FROM ({PAIRS}) p JOIN (SELECT predictor, quantile_cont(x, 0.25) AS q25, quantile_cont(x, 0.75) AS q75 "
    f"FROM ({PAIRS}) WHERE x IS NOT NULL GROUP BY 1) q ON p.predictor = q.predictor GROUP BY 1) e ON c.predictor = e.predictor"
)
def E15_yield_bivariate(t: Tables) -> DataFrame:
    df = S.yield_bivariate(shares(t), PREDICTORS).drop("pearson_p", "spearman_p")
    digits = {"x_mean": 4, "y_mean": 4, "slope": 4, "intercept": 2, "low_mean": 4, "high_mean": 4, "pearson_r": 6, "spearman_r": 6, "r2": 6}
    return df.select("predictor", "n", *(F.round(c, d).alias(c) for c, d in digits.items()))


def p_sql(r: str) -> str:
    """The two-sided p-value of a correlation of n pairs: Simpson's rule on the density of the correlation's arc sine, cos(u) ** (n - 3)."""
    part = lambda low: f"(SELECT sum((CASE WHEN i IN (0, 4000) THEN 1 WHEN i % 2 = 1 THEN 4 ELSE 2 END) * cos(least({low} + (pi() / 2 - {low}) * i / 4000, pi() / 2)) ** (n - 3)) * (pi() / 2 - {low}) FROM range(0, 4001) AS g(i))"
    return f"CASE WHEN {r} IS NULL OR n < 3 THEN NULL WHEN abs({r}) >= 1 THEN 0 ELSE round({part(f'asin(abs({r}))')} / {part('0')}, 6) END"


@query(
    f"SELECT predictor, n, round(r, 6) AS pearson_r, round(s, 6) AS spearman_r, {p_sql('r')} AS pearson_p, {p_sql('s')} AS spearman_p "
    f"FROM ({corr_sql(PAIRS, 'predictor')})"
)
def J1_corr_p_value(t: Tables) -> DataFrame:
    return rounded(S.yield_bivariate(shares(t), PREDICTORS).select("predictor", "n", "pearson_r", "pearson_p", "spearman_r", "spearman_p"))


PAIRWISE = " UNION ALL ".join(f"SELECT '{a}' AS a, '{b}' AS b, CAST({a} AS DOUBLE) AS x, CAST({b} AS DOUBLE) AS y FROM {{shares}}" for a, b in combinations(VARIABLES, 2))


@query(
    "SELECT ka AS a, kb AS b, n, round(r, 6) AS pearson_r, round(s, 6) AS spearman_r "
    f"FROM ({corr_sql(PAIRWISE.replace('AS a,', 'AS ka,').replace('AS b,', 'AS kb,'), 'ka, kb')})"
)
def E16_pairwise_corr(t: Tables) -> DataFrame:
    return rounded(S.pairwise_corr(shares(t), VARIABLES))


BINNED = f"""WITH p AS (SELECT variable AS predictor, value AS x, unscaled_yield AS y
    FROM ({long_sql(['unscaled_yield'], PREDICTORS)}) WHERE value IS NOT NULL AND unscaled_yield IS NOT NULL),
d AS (SELECT predictor, count(DISTINCT x) AS k, list_sort(list(x)) AS s FROM p GROUP BY 1),
cuts AS (SELECT predictor, k, s, least(10, k) AS q, unnest(range(0, least(10, k) + 1)) AS i FROM d),
spots AS (SELECT predictor, k, s, (len(s) - 1) * (i / q) AS spot FROM cuts),
e AS (SELECT predictor, k <= 2 OR predictor = 'annual_tillage' AS single,
    list_sort(list(DISTINCT s[CAST(floor(spot) AS INT) + 1] + (s[CAST(ceil(spot) AS INT) + 1] - s[CAST(floor(spot) AS INT) + 1]) * (spot - floor(spot)))) AS edges
    FROM spots GROUP BY predictor, k),
b AS (SELECT p.predictor, single, edges, x, y, CASE WHEN single THEN x ELSE 1 + len(list_filter(edges[2:-2], lambda v: v < x)) END AS bin
    FROM p JOIN e ON p.predictor = e.predictor)
SELECT predictor, CASE WHEN single THEN bin ELSE dense_rank() OVER (PARTITION BY predictor ORDER BY bin) END AS bin_order, count(*) AS n,
    round(CASE WHEN single THEN bin ELSE coalesce(any_value(edges)[CAST(bin AS INT)], any_value(edges)[1]) END, 6) AS bin_low,
    round(CASE WHEN single THEN bin ELSE coalesce(any_value(edges)[CAST(bin AS INT) + 1], any_value(edges)[1]) END, 6) AS bin_high,
    round(min(x), 6) AS x_min, round(max(x), 6) AS x_max, round(avg(x), 4) AS x_mean, round(avg(y), 4) AS y_mean, round(quantile_cont(y, 0.5), 4) AS y_median
FROM b GROUP BY predictor, single, bin"""


@query(f"SELECT * FROM ({BINNED})")
def E17_binned_yield(t: Tables) -> DataFrame:
    df = S.binned_yield(shares(t), PREDICTORS)
    return df.select("predictor", "bin_order", "n", *(F.round(c, 6).alias(c) for c in ("bin_low", "bin_high", "x_min", "x_max")), *(F.round(c, 4).alias(c) for c in ("x_mean", "y_mean", "y_median")))


@query(
    "SELECT annual_tillage, count(*) AS n, round(avg(unscaled_yield), 4) AS mean, round(coalesce(stddev_samp(unscaled_yield), 0), 4) AS std, "
    "round(quantile_cont(unscaled_yield, 0.5), 4) AS median FROM {joined} WHERE annual_tillage IS NOT NULL GROUP BY 1"
)
def E18_tillage_yield_summary(t: Tables) -> DataFrame:
    return rounded(S.group_summary(joined(t), "annual_tillage", "unscaled_yield"), 4)


MEANS = ["unscaled_yield", "NCCPI", "vpdmax_7", "vpdmax_8", "tillage_0_prop"]


@query(
    "SELECT focal_fips, count(*) AS rows, count(DISTINCT tile_field_ID) AS fields, count(DISTINCT (tile_field_ID, year)) AS field_years, "
    "count(DISTINCT FIPS) AS source_counties, min(year) AS year_min, max(year) AS year_max, "
+ ", ".join(f"round(avg({c}), 4) AS mean_{c}" for c in MEANS) + " FROM {hood} GROUP BY 1")
def E19_county_profile(t: Tables) -> DataFrame:
    return rounded(S.county_profile(hood(t), MEANS), 4)


def digits_sql(x: str) -> str:
    """Six digits of a number; a predictor that hardly varies has slopes of many millions, which no fixed number of decimals fits."""
    size = f"pow(10e0, floor(log10(abs({x}))))"
    return f"CASE WHEN {x} = 0 THEN 0e0 ELSE round(round({x} / {size}, 5) * {size}, 6) END"


def six_digits(c: str) -> F.Column:
    size = F.pow(F.lit(10.0), F.floor(F.log10(F.abs(F.col(c)))))
    return F.when(F.col(c) == 0, 0.0).otherwise(F.round(F.round(F.col(c) / size, 5) * size, 6)).alias(c)


@query(
    f"SELECT focal_fips, predictor, n, round(r, 6) AS r, {digits_sql('slope')} AS slope, {digits_sql('intercept')} AS intercept, round(r * r, 6) AS r2 "
    "FROM (SELECT focal_fips, variable AS predictor, count(*) AS n, CASE WHEN min(x) < max(x) AND min(y) < max(y) THEN corr(x, y) END AS r, CASE "
    "WHEN min(x) < max(x) AND min(y) < max(y) THEN regr_slope(y, x) END AS slope, CASE WHEN min(x) < max(x) AND min(y) < max(y) THEN regr_intercept(y, x) END AS intercept "
    f"FROM (SELECT focal_fips, variable, value AS x, unscaled_yield AS y FROM ({long_sql(['focal_fips', 'unscaled_yield'], PREDICTORS, '{hood_shares}')})) "
    "WHERE x IS NOT NULL GROUP BY 1, 2)"
)
def E20_county_bivariate(t: Tables) -> DataFrame:
    df = S.county_bivariate(rounded_shares(hood(t)), PREDICTORS)
    return df.select("focal_fips", "predictor", "n", F.round("r", 6).alias("r"), six_digits("slope"), six_digits("intercept"), F.round("r2", 6).alias("r2"))


@query(
    "SELECT count(*) AS conflicts FROM (SELECT tile_field_ID, year FROM {hood} GROUP BY 1, 2 HAVING count(DISTINCT unscaled_yield) > 1 OR "
    "count(DISTINCT focal_fips) > 1)"
)
def E21_duplicate_conflicts(t: Tables) -> DataFrame:
    return S.duplicate_conflicts(hood(t), ["unscaled_yield", "focal_fips"])


@query("SELECT tile_field_ID, year, focal_fips FROM (SELECT *, row_number() OVER (PARTITION BY tile_field_ID, year ORDER BY focal_fips) AS r FROM {hood}) WHERE r = 1")
def F1_dedupe_field_year(t: Tables) -> DataFrame:
    rows = hood(t).select("tile_field_ID", "year", "focal_fips", F.lit("p").alias("path"))
    return S.dedupe_field_year(rows).select("tile_field_ID", "year", "focal_fips")


@query(
    "SELECT count(*) AS neighborhood_rows, count(DISTINCT focal_fips) AS focal_counties, min(year) AS year_min, max(year) AS year_max, "
    "count(DISTINCT (tile_field_ID, year)) AS unique_rows, count(DISTINCT tile_field_ID) AS unique_fields, round(count(*) / count(DISTINCT (tile_field_ID, "
    "year)), 6) AS duplication_factor FROM {hood}"
)
def E38_eda_summary(t: Tables) -> DataFrame:
    rows = hood(t).withColumn("path", F.lit("p"))
    return rounded(S.eda_summary(rows, S.dedupe_field_year(rows)))


@query(
    "SELECT state, vpdmax_7, rank() OVER (PARTITION BY state ORDER BY vpdmax_7) + (count(*) OVER (PARTITION BY state, vpdmax_7) - 1) / 2.0 AS rank, "
    "tile_field_ID, year FROM {joined} WHERE vpdmax_7 IS NOT NULL"
)
def F5_avg_rank(t: Tables) -> DataFrame:
    rows = stored(joined(t).select("state", "vpdmax_7", "tile_field_ID", "year"), "rows")
    return S.with_rank(rows, "vpdmax_7", ["state"])


@query(f"SELECT predictor, round(r, 6) AS pearson_r FROM ({corr_sql(PAIRS, 'predictor')}) WHERE r IS NOT NULL ORDER BY abs(r) DESC, predictor LIMIT 5")
def G2_strongest_signals(t: Tables) -> DataFrame:
    return rounded(S.strongest_signals(S.yield_bivariate(shares(t), PREDICTORS).select("predictor", "pearson_r"), 5, "pearson_r", ["predictor"]))


@query(
    "SELECT tile_field_ID, year, unscaled_yield FROM {joined} WHERE vpdmax_7 IS NOT NULL AND annual_tillage IS NOT NULL AND unscaled_yield IS NOT NULL "
    "ORDER BY md5(concat(tile_field_ID, '|', CAST(year AS VARCHAR), '|42')), tile_field_ID, year LIMIT 50000"
)
def G3_plot_sample(t: Tables) -> DataFrame:
    return S.plot_sample(joined(t), ["unscaled_yield", "vpdmax_7", "annual_tillage"], ["tile_field_ID", "year"]).select("tile_field_ID", "year", "unscaled_yield")


@query(
    "SELECT annual_tillage, round(q[1], 4) AS q1, round(q[2], 4) AS median, round(q[3], 4) AS q3, round((SELECT min(unscaled_yield) FROM {joined} j "
    "WHERE j.annual_tillage = b.annual_tillage AND unscaled_yield >= q[1] - 1.5 * (q[3] - q[1])), 4) AS whisker_low, round((SELECT max(unscaled_yield) "
    "FROM {joined} j WHERE j.annual_tillage = b.annual_tillage AND unscaled_yield <= q[3] + 1.5 * (q[3] - q[1])), 4) AS whisker_high "
    "FROM (SELECT annual_tillage, quantile_cont(unscaled_yield, [0.25, 0.5, 0.75]) AS q FROM {joined} WHERE annual_tillage IS NOT NULL GROUP BY 1) b"
)
def E34_box_stats(t: Tables) -> DataFrame:
    return rounded(S.box_stats(joined(t), "annual_tillage", "unscaled_yield"), 4)


@query(" UNION ALL ".join(f"SELECT '{v}' AS predictor, round(avg({v}), 4) AS mean FROM {{shares}}" for v in PREDICTORS))
def S1_union_predictors(t: Tables) -> DataFrame:
    rows = stored(shares(t), "shares")
    return S.union_predictors([rows.agg(F.round(F.avg(v), 4).alias("mean")).select(F.lit(v).alias("predictor"), "mean") for v in PREDICTORS])


@query("SELECT c_custkey, trim(raw_number) IN ('1.5', '7', '-2e2') AS numeric FROM {messy} WHERE raw_number IS NOT NULL")
def H8_to_number(t: Tables) -> DataFrame:
    return t.messy.where("raw_number IS NOT NULL").select("c_custkey", K.to_number(F.col("raw_number")).isNotNull().alias("numeric"))
