"""Deliveries that are whole or not made, checks within the job at hand, and the box join with either side crowded."""

from __future__ import annotations

import os

import numpy as np
import pytest
from pyspark.sql import functions as F

from terrasheaf.operators import cropyear as Y
from terrasheaf.operators import quality as Q
from terrasheaf.operators import spatial as P
from terrasheaf.sources import tables as R


def counties(spark, path):
    return sorted((r["focal_fips"], r["n"]) for r in spark.read.schema("n long, focal_fips string").parquet(path).collect())


def test_a_failed_run_leaves_the_old_delivery_whole(spark, tmp_path):
    path = f"{tmp_path}/out"
    first = spark.createDataFrame([(1, "01001"), (2, "01003")], "n long, focal_fips string")
    R.write_neighborhoods(first, path)
    broken = first.withColumn("n", F.when(F.col("n") == 2, F.raise_error("no")).otherwise(F.col("n")).cast("long"))
    with pytest.raises(Exception, match="no"):
        R.write_neighborhoods(broken, path)
    assert counties(spark, path) == [("01001", 1), ("01003", 2)] and os.listdir(tmp_path) == ["out"]
    R.write_neighborhoods(first.where("n = 1"), path)
    assert counties(spark, path) == [("01001", 1)] and os.listdir(tmp_path) == ["out"]


def test_a_delivery_that_cannot_be_put_in_place_is_undone(spark, tmp_path, monkeypatch):
    (tmp_path / "out").mkdir()
    (tmp_path / "out" / "old").write_text("x")

    def write(draft):
        os.mkdir(draft)
        os.rename(draft, draft + "-gone")

    with pytest.raises(OSError):
        R.staged(f"{tmp_path}/out", write)
    assert (tmp_path / "out" / "old").read_text() == "x"


def test_single_counties_are_replaced(spark, tmp_path):
    path = f"{tmp_path}/out"
    R.write_neighborhoods(spark.createDataFrame([(1, "01001"), (2, "01003")], "n long, focal_fips string"), path)
    R.replace_neighborhoods(spark.createDataFrame([(7, "01003"), (8, "01005")], "n long, focal_fips string"), path)
    assert counties(spark, path) == [("01001", 1), ("01003", 7), ("01005", 8)]


def test_rows_are_counted_while_they_are_written(spark, tmp_path):
    field = spark.createDataFrame([("a", 1), ("b", 2)], "field_id string, n int")
    boundary = spark.createDataFrame([("x", [1.0]), ("y", [2.0]), ("z", [3.0])], "field_boundary_id string, ring array<double>")
    assert R.write_field_tables(field, boundary, f"{tmp_path}/t") == {"field": 2, "field_boundary": 3}
    assert spark.read.csv(f"{tmp_path}/t/field_boundary.csv", header=True).columns == ["field_boundary_id"]
    watched, seen = Q.observed(field, {"large": F.col("n") > 1})
    assert watched.count() == 2 and seen.get == {"rows": 2, "large": 1}


def test_a_repeated_key_ends_the_job(spark):
    rows = spark.createDataFrame([(1, "a"), (2, "b"), (None, "c")], "k int, v string")
    assert sorted(r["v"] for r in Q.unique_or_error(rows, ["k"]).collect()) == ["a", "b", "c"]
    twice = Q.unique_or_error(rows.unionByName(rows.where("k = 2")), ["k"])
    with pytest.raises(Exception, match="duplicate key"):
        twice.count()


def test_deliveries_are_compared_by_partition(spark):
    files = spark.createDataFrame([("file:/run1/out/a=1/b=x/part-0.txt",), ("file:/run1/one.txt",)], "path string")
    assert [r["path"] for r in Y.in_delivery(files).collect()] == ["/a=1/b=x", ""]


@pytest.mark.parametrize("crowded,task", [(10**9, 10**9), (3, 10), (10**9, 5)])
@pytest.mark.parametrize("swapped", [False, True])
def test_box_join_with_either_side_crowded(spark, monkeypatch, crowded, task, swapped):
    monkeypatch.setattr(P, "CROWDED_BOXES", crowded)
    monkeypatch.setattr(P, "TASK_BOXES", task)
    rng = np.random.default_rng(9)
    few = [(f"f{k}", float(x), float(y), float(x + 40), float(y + 40)) for k, (x, y) in enumerate(rng.integers(-50, 50, (3, 2)))]
    many = [(f"m{k}", float(x), float(y), float(x + w), float(y + h)) for k, (x, y, w, h) in enumerate(rng.integers(0, 12, (60, 4)))] + [("null", None, 0.0, 1.0, 1.0)]
    a, b = (many, few) if swapped else (few, many)
    box = "minx double, miny double, maxx double, maxy double"
    got = P.bbox_intersect_join(spark.createDataFrame(a, f"box_id string, {box}"), spark.createDataFrame(b, f"feature_id string, {box}"), 5.0).collect()
    want = {(p[0], q[0]) for p in a for q in b if p[1] is not None and q[1] is not None and p[1] <= q[3] and q[1] <= p[3] and p[2] <= q[4] and q[2] <= p[4]}
    assert len(got) == len(want) and {tuple(r) for r in got} == want
