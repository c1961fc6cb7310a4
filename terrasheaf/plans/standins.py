"""Field-year tables derived from the star-schema tables, in SQL that Spark and DuckDB share; {name} stands for another table."""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession

from terrasheaf.runtime import bucketed, stored

TABLES = "region nation customer supplier part orders lineitem events".split()

TILE = "concat('h', lpad(CAST({0} % 5 AS STRING), 2, '0'), 'v', lpad(CAST(CAST(floor({0} / 5) AS BIGINT) % 4 AS STRING), 2, '0'))"



def weighted(x: str) -> str:
    """The mean of ``x`` weighted by overlap, to six digits, halves up. Areas are whole numbers and values of ``valu1`` whole 204,800ths (cents by 2,048,
    or 64ths), so it is reckoned in whole numbers: of sums of doubles the order of addition would decide where a half goes."""
    area = f"sum(CASE WHEN {x} IS NOT NULL THEN CAST(overlap_area AS BIGINT) END)"
    parts = f"sum(CASE WHEN {x} IS NOT NULL THEN CAST(overlap_area AS BIGINT) * CAST(round({x} * 204800) AS BIGINT) END)"
    twice = f"(2000000 * {parts} + 204800 * {area})"
    return f"round(({twice} - {twice} % (409600 * {area})) / (409600 * {area})) / 1000000"


STANDINS = {
    "keys": 
        f"SELECT c_custkey, {TILE.format('c_custkey')} AS tile_coord, CAST(c_custkey AS STRING) AS field_ID, concat({TILE.format('c_custkey')}, '_', "
        f"CAST(c_custkey AS STRING)) AS tile_field_ID, lpad(CAST(1001 + 2 * c_nationkey AS STRING), 5, '0') AS FIPS, c_nationkey FROM {{customer}}"
    ,
    "corn": 
        "SELECT k.tile_coord, k.field_ID, k.tile_field_ID, CAST(year(o_orderdate) AS INT) AS year, round(avg(o_totalprice), 6) AS unscaled_yield, "
        "count(*) AS pixel_count FROM {orders} o JOIN {keys} k ON o.o_custkey = k.c_custkey GROUP BY k.tile_coord, k.field_ID, k.tile_field_ID, "
        "year(o_orderdate)"
    ,
    "lines": 
        "SELECT k.tile_coord, k.field_ID, k.tile_field_ID, k.FIPS, l_partkey, l_suppkey, l_linenumber, l_orderkey, l_quantity, l_extendedprice, l_discount, "
        "l_returnflag, l_shipdate, CAST(year(l_shipdate) AS INT) AS year, CAST(month(l_shipdate) AS INT) AS month FROM {lineitem} l "
        "JOIN {orders} o ON l.l_orderkey = o.o_orderkey JOIN {keys} k ON o.o_custkey = k.c_custkey"
    ,
    "tillage_counts": 
        "SELECT tile_coord, field_ID, tile_field_ID, year, sum(CASE WHEN l_returnflag = 'R' THEN 1 ELSE 0 END) AS n0, sum(CASE WHEN l_returnflag = 'A' THEN 1 "
        "ELSE 0 END) AS n1, sum(CASE WHEN l_returnflag = 'N' THEN 1 ELSE 0 END) AS nna, count(*) AS n FROM {lines} GROUP BY tile_coord, field_ID, "
        "tile_field_ID, year"
    ,
    "tillage_wide": 
        "SELECT tile_coord, field_ID, tile_field_ID, year, CAST(n0 AS BIGINT) AS tillage_0_count, CAST(n1 AS BIGINT) AS tillage_1_count, "
        "CAST(nna AS BIGINT) AS tillage_na_count, round(n0 / CAST(n AS DOUBLE), 6) AS tillage_0_prop, round(n1 / CAST(n AS DOUBLE), 6) AS tillage_1_prop, "
        "round(nna / CAST(n AS DOUBLE), 6) AS tillage_na_prop, n AS pixel_count FROM {tillage_counts}"
    ,
    "tillage": 
        "SELECT tile_field_ID, year, CASE WHEN tillage_0_prop > tillage_1_prop THEN 0 WHEN tillage_1_prop > tillage_0_prop THEN 1 END AS annual_tillage, "
        "tillage_0_prop, tillage_1_prop FROM {tillage_wide}"
    ,
    "monthly": 
        "SELECT tile_coord, field_ID AS field_id, tile_field_ID, concat(CAST(year AS STRING), lpad(CAST(month AS STRING), 2, '0')) AS day, "
        "round(avg(l_extendedprice), 6) AS vpdmax_mean, max(l_extendedprice) AS vpdmax_max, count(*) AS pixel_count, l_linenumber % 2 AS source, "
        "l_linenumber AS line FROM {lines} GROUP BY tile_coord, field_ID, tile_field_ID, year, month, l_linenumber"
    ,
    "vpd": 
        "SELECT tile_field_ID, year, max(CASE WHEN month = 7 THEN l_extendedprice END) AS vpdmax_7, max(CASE "
        "WHEN month = 8 THEN l_extendedprice END) AS vpdmax_8 FROM {lines} WHERE month IN (7, 8) GROUP BY tile_field_ID, year"
    ,
    "field_mukey": 
        "SELECT tile_field_ID AS tile_field_id, l_partkey AS mukey, sum(l_quantity) AS overlap_area, count(*) AS cells FROM {lines} GROUP BY tile_field_ID, "
        "l_partkey"
    ,
    "valu1": 
        "SELECT p_partkey AS mukey, CASE WHEN p_partkey % 7 = 0 THEN NULL ELSE p_retailprice / 2048 END AS nccpi3all, CASE WHEN p_size % 5 = 0 THEN NULL "
        "ELSE CAST(p_size AS DOUBLE) / 64 END AS nccpi3corn, CAST(p_size AS DOUBLE) / 32 AS nccpi3soy, CASE WHEN p_partkey % 2 = 0 THEN 'IA' "
        "ELSE 'IL' END AS state_code FROM {part} WHERE p_partkey % 11 <> 0"
    ,
    "soil": 
        f"SELECT m.tile_field_id AS tile_field_ID, {weighted('nccpi3all')} AS NCCPI, {weighted('nccpi3corn')} AS nccpi3corn "
        "FROM {field_mukey} m JOIN {valu1} v ON m.mukey = v.mukey "
        "GROUP BY m.tile_field_id HAVING count(nccpi3all) > 0 AND count(nccpi3corn) > 0"
    ,
    "county": 
        "SELECT tile_field_ID, FIPS, concat('S', CAST(n.n_regionkey AS STRING)) AS state, n.n_name AS county FROM {keys} k "
        "JOIN {nation} n ON k.c_nationkey = n.n_nationkey WHERE k.c_custkey % 17 <> 0"
    ,
    "adjacency": 
        "SELECT lpad(CAST(1001 + 2 * a.n_nationkey AS STRING), 5, '0') AS fipscounty, lpad(CAST(1001 + 2 * b.n_nationkey AS STRING), 5, '0') AS fipsneighbor "
        "FROM {nation} a JOIN {nation} b ON a.n_regionkey = b.n_regionkey AND (a.n_nationkey <> b.n_nationkey OR a.n_nationkey % 2 = 0) "
        "WHERE a.n_nationkey <> 3"
    ,
    "edges": "SELECT DISTINCT fipscounty AS focal_fips, fipsneighbor AS neighbor_fips FROM {adjacency}",
    "joined": 
        "SELECT c.tile_field_ID, c.year, c.unscaled_yield, t.annual_tillage, t.tillage_0_prop, t.tillage_1_prop, v.vpdmax_7, v.vpdmax_8, s.NCCPI, "
        "s.nccpi3corn, k.FIPS, k.state, k.county FROM {corn} c JOIN {tillage} t ON c.tile_field_ID = t.tile_field_ID AND c.year = t.year "
        "JOIN {vpd} v ON c.tile_field_ID = v.tile_field_ID AND c.year = v.year JOIN {soil} s ON c.tile_field_ID = s.tile_field_ID "
        "JOIN {county} k ON c.tile_field_ID = k.tile_field_ID"
    ,
    "model": "SELECT * FROM {joined} WHERE annual_tillage IS NOT NULL AND vpdmax_7 IS NOT NULL AND vpdmax_8 IS NOT NULL",
    "focal": "SELECT DISTINCT m.FIPS AS focal_fips FROM {model} m JOIN {edges} e ON m.FIPS = e.focal_fips",
    "hood": "SELECT e.focal_fips, m.* FROM {model} m JOIN {edges} e ON m.FIPS = e.neighbor_fips JOIN {focal} f ON e.focal_fips = f.focal_fips",
    "shares": 
        "SELECT *, round(greatest(0.0, 1 - coalesce(tillage_0_prop, 0.0) - coalesce(tillage_1_prop, 0.0)), 9) AS tillage_na_prop, "
        "round(coalesce(tillage_0_prop, 0.0) + coalesce(tillage_1_prop, 0.0), 9) AS classified_share, "
        "round(tillage_1_prop / nullif(coalesce(tillage_0_prop, 0.0) + coalesce(tillage_1_prop, 0.0), 0), 9) AS high_share_among_classified, "
        "round(tillage_0_prop / nullif(coalesce(tillage_0_prop, 0.0) + coalesce(tillage_1_prop, 0.0), 0), 9) AS low_share_among_classified FROM {joined}"
    ,
    "hood_shares": "SELECT h.focal_fips, s.* FROM {hood} h JOIN {shares} s ON h.tile_field_ID = s.tile_field_ID AND h.year = s.year"
    ,
    "cells": 
        "SELECT concat('h00v0', CAST(l_suppkey % 3 AS STRING)) AS tile, CAST(l_partkey % 2000 AS INT) AS row, CAST(l_orderkey % 1000 AS INT) AS col, "
        "min(l_linenumber) AS crop, max(l_quantity) AS qty FROM {lineitem} GROUP BY l_suppkey % 3, l_partkey % 2000, l_orderkey % 1000"
    ,
    "field_pixels": "SELECT tile, row, col, CASE WHEN qty > 45 THEN 0 ELSE CAST(floor(row / 100.0) * 100 + floor(col / 50.0) + 1 AS BIGINT) END AS value FROM {cells}",
    "crop_pixels": "SELECT tile, row, col, CASE WHEN crop = 7 THEN 0 ELSE CAST(crop AS BIGINT) END AS value FROM {cells}",
    "value_pixels": "SELECT tile, row, col, qty AS value FROM {cells}",
    "grids": 
        "SELECT DISTINCT tile, CAST(0 AS DOUBLE) AS x0, CAST(0 AS DOUBLE) AS y0, CAST(30 AS DOUBLE) AS dx, CAST(30 AS DOUBLE) AS dy, "
        "CAST(1000 AS INT) AS ncols, CAST(2000 AS INT) AS nrows, 'EPSG:5070' AS crs, CAST(0 AS BIGINT) AS nodata FROM {cells}"
    ,
    "blocks": "SELECT DISTINCT tile, CAST(floor(row / 100.0) AS INT) AS br, CAST(floor(col / 50.0) AS INT) AS bc FROM {cells}",
    "ring_boxes": 
        "SELECT tile, CAST(br * 100 + bc + 1 AS BIGINT) AS field_id, bc * 1500.0 + 10 AS minx, br * 3000.0 + 10 AS miny, bc * 1500.0 + 700 AS maxx, "
        "br * 3000.0 + 910 AS maxy, (br + bc) % 3 AS shape FROM {blocks}"
    ,
    "county_boxes": 
        "SELECT DISTINCT tile, lpad(CAST(1001 + 2 * (CAST(floor(br / 4.0) AS INT) * 10 + CAST(floor(bc / 3.0) AS INT)) AS STRING), 5, '0') AS fips, "
        "CAST(floor(bc / 3.0) AS INT) * 4500.0 + 300 AS minx, CAST(floor(br / 4.0) AS INT) * 12000.0 + 300 AS miny, "
        "CAST(floor(bc / 3.0) AS INT) * 4500.0 + 4800 AS maxx, CAST(floor(br / 4.0) AS INT) * 12000.0 + 12300 AS maxy FROM {blocks}"
    ,
    "messy": 
        "SELECT c_custkey, CASE c_custkey % 5 WHEN 0 THEN concat(CAST(c_custkey AS STRING), '.0') WHEN 1 THEN concat('  ', CAST(c_custkey AS STRING), ' ') "
        "WHEN 2 THEN '' WHEN 3 THEN concat('H01V0', CAST(c_custkey % 4 AS STRING), '_', CAST(c_custkey AS STRING), '.00') ELSE concat('x', "
        "CAST(c_custkey AS STRING)) END AS raw_id, CASE c_custkey % 4 WHEN 0 THEN concat('Tile_H0', CAST(c_custkey % 3 AS STRING), 'V07.tif') "
        "WHEN 1 THEN 'none' WHEN 2 THEN concat('h1', CAST(c_custkey % 7 AS STRING), 'v02') ELSE concat('dir/h03v1', CAST(c_custkey % 9 AS STRING), "
        "' x') END AS raw_tile, CASE c_custkey % 6 WHEN 0 THEN '200507' WHEN 1 THEN '20057' WHEN 2 THEN '199908' WHEN 3 THEN 'abcdef' WHEN 4 THEN '' "
        "ELSE concat('20', lpad(CAST(c_custkey % 100 AS STRING), 2, '0'), '12') END AS raw_month, CASE c_custkey % 5 WHEN 0 THEN '1.5' WHEN 1 THEN 'x' "
        "WHEN 2 THEN NULL WHEN 3 THEN '7' ELSE '-2e2' END AS raw_number FROM {customer}"
    ,
    "draws": "SELECT concat('f', CAST(user_id % 4 AS STRING)) AS fit, event_type AS variable, user_id % 3 AS chain, event_id AS iteration, value FROM {events}",
}


class Tables:
    """The derived tables of one data folder, built when asked for."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark, self.sf_dir, self._made, self._kept = spark, sf_dir, {}, set()

    def __getattr__(self, name: str) -> DataFrame:
        if name.startswith("_"):
            raise AttributeError(name)
        if name not in self._made:
            self._made[name] = self.sql(STANDINS[name]) if name in STANDINS else self.spark.read.parquet(f"{self.sf_dir}/{name}.parquet")
        return self._made[name]

    def keep(self, name: str) -> None:
        """Stores a derived table that a query reads several times."""
        if name not in self._kept:
            self._kept.add(name)
            self._made[name] = stored(getattr(self, name), name)

    def keep_by(self, key: str, *names: str) -> None:
        """Stores derived tables in buckets of one key, by which a query then joins them without an exchange."""
        for name in names:
            if name not in self._kept:
                self._kept.add(name)
                self._made[name] = bucketed(getattr(self, name), name, [key])

    def sql(self, text: str) -> DataFrame:
        names = sorted(set(re.findall(r"\{(\w+)\}", text)))
        return self.spark.sql(text, **{n: getattr(self, n) for n in names})


def with_standins(sql: str) -> str:
    """A DuckDB query with the derived tables it uses, in order, before it."""
    used: list[str] = []

    def add(text: str) -> None:
        for name in re.findall(r"\{(\w+)\}", text):
            if name in STANDINS and name not in used:
                add(STANDINS[name])
                used.append(name)

    add(sql)
    plain = lambda text: re.sub(r"\{(\w+)\}", r"\1", text)
    ctes = ", ".join(f"{n} AS ({plain(STANDINS[n])})" for n in used)
    return (f"WITH {ctes} " if ctes else "") + plain(sql)
