"""Lines that many documents share, against brute force."""

from __future__ import annotations

import random

import numpy as np
import pytest

from terrasheaf.llm import lines


def brute(rows, min_docs, min_chars=1, keep_first=False):
    holders, first = {}, {}
    for r, (i, text) in enumerate(rows):
        for k, line in enumerate((text or "").split("\n")):
            key = "".join(c.lower() if "A" <= c <= "Z" else c for c in line.strip(" \t\n\r\x0b\x0c"))
            if len(key) >= min_chars:
                holders.setdefault(key, set()).add(r)
                first[key] = min(first.get(key, (True, 0, 1 << 60)), (i is None, i or 0, k))
    out = []
    for i, text in rows:
        kept = []
        parts = (text or "").split("\n")
        for k, line in enumerate(parts):
            key = "".join(c.lower() if "A" <= c <= "Z" else c for c in line.strip(" \t\n\r\x0b\x0c"))
            if len(holders.get(key, ())) < min_docs or keep_first and first[key] == (i is None, i or 0, k):
                kept.append(line)
        out.append((i, len(parts), len(parts) - len(kept), "\n".join(kept)))
    return out


def corpus(rnd, n):
    common = [f"Line {k} of all É" for k in range(6)]
    rows = []
    for i in range(n):
        parts = [rnd.choice([rnd.choice(common), rnd.choice(common).upper() + " \t", f"own {i} {rnd.random()}", "", "  ", " ", "x", "é"]) for _ in range(rnd.randint(0, 9))]
        rows.append((rnd.choice([None, i, i, 3]), rnd.choice([None, "\n".join(parts), "\n".join(parts), "\n".join(parts)])))
    return rows + rows[:4]


@pytest.mark.parametrize("min_docs,min_chars,keep_first,segments", [(10, 1, False, None), (2, 1, True, 3), (3, 2, True, 2), (2, 0, False, 1)])
def test_lines_as_by_brute_force(spark, min_docs, min_chars, keep_first, segments):
    rows = corpus(random.Random(min_docs), 80)
    docs = spark.createDataFrame([(i, t, 7, "x") for i, t in rows], "doc_id long, text string, n_lines int, segment string").repartition(3)
    got = lines.drop_shared_lines(docs, min_docs, min_chars, keep_first, segments=segments).collect()
    order = lambda r: (r[0] is None, r[0] or 0, *r[1:])
    assert sorted(map(tuple, got), key=order) == sorted(brute(rows, min_docs, min_chars, keep_first), key=order)


def test_no_rows_and_only_empty_texts(spark):
    assert lines.drop_shared_lines(spark.createDataFrame([], "doc_id long, text string")).collect() == []
    docs = spark.createDataFrame([(None, None), (1, ""), (1, "")], "doc_id long, text string")
    assert sorted(tuple(r)[1:] for r in lines.drop_shared_lines(docs, 2).collect()) == [(1, 0, "")] * 3


def test_a_text_of_many_lines_and_a_line_of_many_characters(spark):
    long = "\n".join(f"row {k % 70_000}" for k in range(140_000))
    wide = "y" * 3_000_000
    docs = spark.createDataFrame([(1, long), (2, f"row 5\n{wide}\nz"), (3, wide)], "doc_id long, text string")
    got = {r["doc_id"]: (r["n_lines"], r["n_dropped"], r["text"][:9]) for r in lines.drop_shared_lines(docs, 2).collect()}
    assert got == {1: (140_000, 2, "row 0\nrow"), 2: (3, 2, "z"), 3: (1, 1, "")}


def test_places_survive_the_shuffle_and_filters_lose_no_repeat():
    rnd = np.random.default_rng(3)
    for n in (0, 1, 5000, 700_000):
        places = np.unique(rnd.integers(0, 1 << lines.SEGMENT_BITS, n))
        assert np.array_equal(lines.places_of(lines.packed_places(places)), places)
    hashes = rnd.integers(0, 1 << 63, (20_000, 2)).astype(np.uint64)
    segments = 3
    twice = {s: np.zeros(1 << lines.SEGMENT_BITS, bool) for s in range(segments)}
    once = {s: np.zeros(1 << lines.SEGMENT_BITS, bool) for s in range(segments)}
    for part in (hashes[:12_000], hashes[8_000:], hashes[:10][[0, 0, 1]]):
        batch = lines.pieces(part, segments)
        for s, a, b in zip(*(batch.column(k).to_pylist() for k in range(3)), strict=True):
            at = lines.places_of(a)
            twice[s][at[once[s][at]]] = True
            once[s][at] = True
            twice[s][lines.places_of(b)] = True
    segment, at = lines.spots(hashes, segments)
    hit = np.array([twice[s][p].all() for s, p in zip(segment.tolist(), at, strict=True)])
    assert hit[8_000:12_000].all() and hit[:2].all() and hit.mean() < 0.25


def test_texts_without_a_shared_line(spark):
    docs = spark.createDataFrame([(k, f"a {k}\nb {k}") for k in range(5)], "doc_id long, text string")
    assert sorted(tuple(r) for r in lines.drop_shared_lines(docs).collect()) == [(k, 2, 0, f"a {k}\nb {k}") for k in range(5)]
