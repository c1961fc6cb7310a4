"""The trie of conversations against brute force, and sums over subtrees against plain ones."""

from __future__ import annotations

import hashlib
import random
import zlib

import pytest

from terrasheaf.llm import trie


def brute(rows):
    """Every prefix of every rebuilt conversation in a dictionary."""
    own = {}
    for c, turn, role, text in rows:
        if c is not None:
            own.setdefault(c, []).append((turn is not None, turn or 0, role or "", text or ""))
    own = {c: [x[2:] for x in sorted(v)] for c, v in own.items()}
    built = {}
    for c, turns in own.items():
        h = zlib.crc32(str(c).encode()) % 6
        built[c] = tuple(own.get(c - c % 100, [])[:h] + turns[h:])
    members = {}
    for c, turns in built.items():
        for d in range(len(turns) + 1):
            members.setdefault(turns[:d], []).append(c)
    out = []
    for node, found in members.items():
        under = [x for x in members if x[: len(node)] == node]
        kids = [x for x in under if len(x) == len(node) + 1]
        leaves = [x for x in under if not any(y[: len(x)] == x and len(y) == len(x) + 1 for y in under)]
        saved = sum((len(members[x]) - 1) * len(x[-1][1]) for x in under if x)
        ends = ",".join(map(str, sorted(c for c in found if built[c] == node)))
        out.append((min(found), len(node), min(members[node[:-1]]) if node else None, len(found), len(kids), len(leaves), saved, hashlib.sha256(ends.encode()).hexdigest()))
    return sorted(out, key=str)


def got(spark, rows, **more):
    table = spark.createDataFrame([(*r, 1, "x") for r in rows], "conv_id long, turn int, role string, text string, depth int, h1 string").repartition(5)
    return sorted((tuple(r) for r in trie.prefix_trie(table, **more).collect()), key=str)


def conversations(rnd, n, words):
    rows = []
    for _ in range(n):
        c = rnd.choice([rnd.randint(0, 12), rnd.randint(100, 130), rnd.randint(-5, 5), 200])
        rows += [(c, rnd.choice([k, k, None, 2]), rnd.choice(["user", "assistant", None]), rnd.choice([*words, None, ""])) for k in range(rnd.randint(1, 4))]
    return rows


@pytest.mark.parametrize("seed,part_rows", [(1, 1 << 17), (2, 3), (3, 5)])
def test_trie_as_by_brute_force(spark, seed, part_rows):
    rnd = random.Random(seed)
    rows = conversations(rnd, 40, ["a", "é🙂", "long text"])
    rows += [(300 + k, d, "user", "same") for k in (0, 1, 2, 3) for d in range(12)] + [(k, d, "user", f"{d}") for k in (401, 402, 500) for d in range(25)] + [(None, 1, "user", "x")]
    assert got(spark, rows, part_rows=part_rows) == brute(rows)


def test_small_tables(spark):
    assert got(spark, []) == []
    assert got(spark, [(None, 1, "user", "x")]) == []
    one = next(c for c in range(1, 99) if zlib.crc32(str(c).encode()) % 6)
    for rows in ([(one, 0, "u", "gone")], [(0, None, None, None)] * 3, [(0, 1, "u", "y" * 2_000_000), (one, 1, "u", "z")]):
        assert got(spark, rows) == brute(rows)


@pytest.mark.parametrize("seed", range(6))
def test_sums_over_subtrees(seed):
    rnd = random.Random(seed)
    n = [1, 2, 40, 3000, 20_000, 20_000][seed]
    parents = [-1 if k == 0 or rnd.random() < 0.01 else k - 1 if seed == 4 else rnd.randrange(max(0, k - 30), k) for k in range(n)]
    values = [[rnd.randint(0, 9) for _ in range(n)], [rnd.randint(0, 10**15) for _ in range(n)]]
    want = [list(v) for v in values]
    for column in want:
        for k in range(n - 1, 0, -1):
            if parents[k] >= 0:
                column[parents[k]] += column[k]
    assert trie.rollup(parents, values) == want
    assert trie.rollup([], [[], []]) == [[], []]
