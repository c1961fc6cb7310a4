"""Derived tables whose figures must not hang on the order of addition, and queries that read the large tables once."""

from __future__ import annotations

import os
from fractions import Fraction
from math import floor

import duckdb
import numpy as np
import pytest
from pyspark.sql import SparkSession

from terrasheaf.plans import assembly, exploration, grids, registry, sources  # noqa: F401
from terrasheaf.plans.standins import STANDINS, Tables

DATA = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")


def halves(n: int) -> tuple[list[tuple], list[tuple], dict[str, float]]:
    """Fields whose weighted mean lies half-way between two numbers of six digits, and the higher one."""
    rng, areas, values, want = np.random.default_rng(3), [], [], {}
    for k in range(n):
        cents = [int(c) for c in rng.integers(90_000, 110_000, 4)]
        weights = [7, 9, 8, 1]
        cents[3] += (64 - sum(w * c for w, c in zip(weights, cents, strict=True))) % 128
        mean = Fraction(sum(w * c for w, c in zip(weights, cents, strict=True)), 204_800 * 25)
        assert (2_000_000 * mean).denominator == 1 and (2_000_000 * mean).numerator % 2
        want[f"f{k}"] = floor(1_000_000 * mean + Fraction(1, 2)) / 1_000_000
        for j, (w, c) in enumerate(zip(weights, cents, strict=True)):
            areas.append((f"f{k}", 4 * k + j, float(w)))
            values.append((4 * k + j, c / 100 / 2048, 0.5))
    return areas, values, want


def test_soil_rounds_halves_alike_in_any_order(spark: SparkSession):
    areas, values, want = halves(300)
    for order in (1, -1):
        t = Tables(spark, DATA)
        t._made["field_mukey"] = spark.createDataFrame(areas[::order], "tile_field_id string, mukey long, overlap_area double")
        t._made["valu1"] = spark.createDataFrame(values[::order], "mukey long, nccpi3all double, nccpi3corn double")
        assert {r["tile_field_ID"]: r["NCCPI"] for r in t.soil.collect()} == want
        con = duckdb.connect()
        con.execute("CREATE TABLE field_mukey (tile_field_id VARCHAR, mukey BIGINT, overlap_area DOUBLE)")
        con.execute("CREATE TABLE valu1 (mukey BIGINT, nccpi3all DOUBLE, nccpi3corn DOUBLE)")
        con.executemany("INSERT INTO field_mukey VALUES (?, ?, ?)", areas[::order])
        con.executemany("INSERT INTO valu1 VALUES (?, ?, ?)", values[::order])
        found = con.execute(STANDINS["soil"].replace("{", "").replace("}", "")).fetchall()
        assert {r[0]: r[1] for r in found} == want


@pytest.mark.parametrize("name", ["D10_bbox_intersect_join", "D12_select_intersecting", "D6_manifest_join"])
def test_derived_tables_are_stored(spark: SparkSession, name: str):
    """What the query joins was derived once, so its last plan does not go back to the lines."""
    assert not [f for f in registry.queries()[name](spark, DATA).inputFiles() if "lineitem" in f]
