"""The driver contract."""

from __future__ import annotations

import __spark_entry__


def test_entry_and_names(spark):
    rows = __spark_entry__.entry(spark).collect()
    assert rows and {"focal_fips", "neighbor_count", "row_count"} <= set(rows[0].asDict())
    known, oracles = __spark_entry__.queries(), __spark_entry__.oracle_sql()
    assert set(oracles) <= set(known)
    assert len(known) > 140


def test_a_query_may_run_twice_in_a_session(spark):
    sf = "/root/testdata/sf0.001"
    one, two = (sorted(map(tuple, __spark_entry__.queries()["S3_focal_set"](spark, sf).collect())) for _ in range(2))
    assert one == two
