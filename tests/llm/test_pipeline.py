"""The pipeline's stages against brute force, and their edge cases."""

from __future__ import annotations

import random

import corpus_pipeline
from terrasheaf.llm import pii, queries

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, kept boolean, contaminated boolean"


def prose(rnd, n):
    return " ".join("".join(rnd.choice("abcdefgh") for _ in range(rnd.randint(1, 6))) for _ in range(n))


def frame(spark, rows):
    return spark.createDataFrame([(i, t, "en", "s", len(t or ""), False, True) for i, t in rows], SCHEMA)


def test_stages_do_their_work(spark, tmp_path):
    rnd = random.Random(1)
    clean = [prose(rnd, 200) for _ in range(6)]
    item = prose(rnd, 30)
    rows = list(enumerate(clean)) + [(10, clean[0]), (10, clean[0]), (11, "too short"), (12, None), (13, f"{prose(rnd, 100)} {item} {prose(rnd, 100)}"), (14, f"{prose(rnd, 200)} mail a.b@c.org now"), (None, prose(rnd, 90))]
    spark.createDataFrame([(1, item), (2, None)], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    docs = frame(spark, rows)
    docs.write.parquet(f"{tmp_path}/documents.parquet")
    stage = dict(corpus_pipeline.STAGES)
    kept = stage["quality rules"](spark, docs, str(tmp_path))
    assert kept.columns == corpus_pipeline.COLUMNS
    assert sorted((r["doc_id"] is None, r["doc_id"] or 0) for r in kept.collect()) == [(False, i) for i in (0, 1, 2, 3, 4, 5, 10, 10, 13, 14)] + [(True, 0)]
    single = stage["near-duplicates"](spark, kept, str(tmp_path))
    assert sorted(r["doc_id"] if r["doc_id"] is not None else -1 for r in single.collect()) == [-1, 0, 1, 2, 3, 4, 5, 13, 14]
    pure = stage["decontamination"](spark, single, str(tmp_path))
    assert sorted(r["doc_id"] if r["doc_id"] is not None else -1 for r in pure.collect()) == [-1, 0, 1, 2, 3, 4, 5, 14]
    masked = {r["doc_id"]: r for r in stage["personal data"](spark, pure, str(tmp_path)).collect()}
    assert "[EMAIL]" in masked[14]["text"] and "a.b@c.org" not in masked[14]["text"] and masked[14]["n_chars"] == len(masked[14]["text"])
    assert masked[1]["text"] == clean[1] and not any(pii.identifiers(r["text"]) for r in masked.values())
    packed = corpus_pipeline.run(spark, str(tmp_path)).collect()
    assert {r["doc_id"] for r in packed} == set(masked)


def test_stages_take_empty_tables(spark, tmp_path):
    spark.createDataFrame([], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    for _, stage in corpus_pipeline.STAGES:
        assert stage(spark, frame(spark, []), str(tmp_path)).collect() == []


def test_every_operator_has_a_query():
    numbers = sorted(int(n[2:].split("_")[0]) for n in queries.queries())
    assert numbers == list(range(1, 14))


def test_near_duplicates_lose_no_text_with_equal_or_null_ids(spark, tmp_path):
    rnd = random.Random(2)
    v, w, x, y = (prose(rnd, 150) for _ in range(4))
    rows = [(3, v), (5, w), (5, v), (None, x), (None, x), (None, y), (9, y), (9, y), (9, None), (None, "")]
    want = [(None, x), (3, v), (5, w), (9, None), (9, y)]
    stage = dict(corpus_pipeline.STAGES)["near-duplicates"]
    order = lambda r: (r[0] or 0, r[1] or "")
    for given in (rows, rows[::-1], rows[5:] + rows[:5]):
        got = stage(spark, frame(spark, given), str(tmp_path)).collect()
        assert sorted([(r["doc_id"], r["text"]) for r in got], key=order) == sorted(want, key=order)
