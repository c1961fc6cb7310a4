"""Conversations as a trie of what they begin with, and sums over its subtrees by centroid decomposition."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from terrasheaf.llm.common import join_counted, materialize

#: Turns in and below a node of the trie that make it heavy; a part of the trie that one task decomposes has fewer.
PART_ROWS = 1 << 17
#: Conversations of a block of so many share the first turns of the block's first, so many of them less one at most.
BLOCK, SHARED = 100, 6
#: Characters of a list of ids that is handed on in one row.
CHUNK_CHARS = 4096
NODE, PARENT = ["depth", "h1", "h2"], ["q0", "q1", "q2"]


def rollup(parents: list[int], values: list[list[int]]) -> list[list[int]]:
    """For a forest (each node's parent before it, -1 for a top) the sums of each column of ``values`` over every node's subtree.

    All components are split at once, round by round: the centroid is the deepest node that has half of its component in and below it. The
    total of that lower part is added along the path from above the centroid to the top; then the edges at the centroid are cut. A component
    is half as large in the next round, so the rounds are as many as the logarithm of the nodes, each with as many steps as there are nodes,
    whatever the depth."""
    n = len(parents)
    up, totals = list(parents), [list(v) for v in values]
    top, size, centre, low = [0] * n, [0] * n, [0] * n, [False] * n
    alive = list(range(n))
    while alive:
        for i in alive:
            size[i] = 1
            top[i] = i if up[i] < 0 else top[up[i]]
        for i in reversed(alive):
            if up[i] >= 0:
                size[up[i]] += size[i]
        alive = [i for i in alive if size[top[i]] > 1]
        for i in alive:
            if 2 * size[i] >= size[top[i]]:
                centre[top[i]] = i
        centres = {centre[top[i]] for i in alive}
        for i in alive:
            low[i] = i in centres or up[i] >= 0 and low[up[i]]
        for column, own in zip(totals, values, strict=True):
            below = dict.fromkeys(centres, 0)
            for i in alive:
                if low[i]:
                    below[centre[top[i]]] += own[i]
            for c, total in below.items():
                column[c] += total - own[c]
                j = up[c]
                while j >= 0:
                    column[j] += total
                    j = up[j]
        for i in reversed(alive):
            if i in centres or up[i] in centres:
                up[i] = -1
        alive = [i for i in alive if i not in centres]
    return totals


def key(prefix: str = "") -> Column:
    return F.struct(*(F.col(prefix + n).alias(n) for n in NODE))


def carried(rows: DataFrame, totals: dict[str, Column], name: str = "carry") -> DataFrame:
    """Running totals within a conversation whose rows lie in ranges: (conv_id, range) with each of ``totals`` over all earlier ranges."""
    earlier = Window.partitionBy("conv_id").orderBy("range").rowsBetween(Window.unboundedPreceding, -1)
    sums = rows.groupBy("conv_id", "range").agg(*(c.alias(n) for n, c in totals.items()))
    return sums.select("conv_id", "range", *((F.bit_xor(n) if n.startswith("h") else F.max(n)).over(earlier).alias(f"{name}_{n}") for n in totals))


def turns_in_order(conversations: DataFrame) -> DataFrame:
    """(conv_id, range, pos, a, b, chars): every turn with its place in its conversation, two hashes of role and text, and the text's length.

    Turns are dealt to ranges in order and numbered range by range, so a conversation of any length is spread over the cluster."""
    order = ["conv_id", "turn", "role", "text"]
    blank = lambda c: F.coalesce(F.col(c).cast("string"), F.lit("")).alias(c)
    rows = conversations.select(F.col("conv_id").cast("long").alias("conv_id"), "turn", blank("role"), blank("text")).where("conv_id IS NOT NULL")
    sorted_ = rows.repartitionByRange(*order).sortWithinPartitions(*order)
    at = sorted_.select("conv_id", F.monotonically_increasing_id().alias("at"), *(F.xxhash64(F.lit(k), "role", "text").alias(n) for k, n in ((1, "a"), (2, "b"))), F.char_length("text").cast("long").alias("chars"))
    dealt = materialize(at.withColumn("range", F.shiftright("at", 33)), "turns")
    spans = dealt.groupBy("conv_id", "range").agg(F.min("at").alias("first"), F.count(F.lit(1)).alias("n"))
    earlier = Window.partitionBy("conv_id").orderBy("range").rowsBetween(Window.unboundedPreceding, -1)
    starts = spans.select("conv_id", "range", (F.coalesce(F.sum("n").over(earlier), F.lit(0)) - F.col("first") + 1).alias("shift"))
    return dealt.join(starts, ["conv_id", "range"]).select("conv_id", "range", (F.col("at") + F.col("shift")).alias("pos"), "a", "b", "chars")


def rebuilt(turns: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The chains (conv_id, range, depth, length, chars, h1, h2, q1, q2) of rebuilt conversations, with the hash of all turns so far and of those
    before, and the conversations (conv_id, length).

    The hash of a sequence is the exclusive or of its turns' hashes, each with its place, in two halves of 64 bits; so it is a running sum that
    ranges can be joined to."""
    shared = F.crc32(F.col("conv_id").cast("string").cast("binary")) % SHARED
    own = turns.groupBy("conv_id").agg(F.count(F.lit(1)).alias("n_own")).select("conv_id", "n_own", shared.alias("h"), (F.col("conv_id") - F.pmod(F.col("conv_id"), F.lit(BLOCK))).alias("base"))
    own = materialize(own, "own-lengths")
    bases = own.select(F.col("conv_id").alias("base"), F.col("n_own").alias("n_base"))
    convs = own.join(bases, "base", "left").withColumn("k", F.least("h", F.coalesce("n_base", F.lit(0))))
    convs = materialize(convs.select("conv_id", "base", "n_own", "h", "k", (F.col("k") + F.greatest(F.col("n_own") - F.col("h"), F.lit(0))).alias("length")), "conversations")
    heads = turns.where((F.col("pos") < SHARED) & (F.col("conv_id") % BLOCK == 0)).select(F.col("conv_id").alias("base"), "pos", "a", "b", "chars")
    lent = convs.where("k > 0").join(heads, "base").where("pos <= k").select("conv_id", F.lit(-1).cast("long").alias("range"), F.col("pos").alias("depth"), "length", "a", "b", "chars")
    kept = join_counted(turns.where(F.col("pos") > shared), convs.select("conv_id", "n_own", "h", "k", "length"), "conv_id", "n_own")
    kept = kept.select("conv_id", "range", (F.col("pos") - F.col("h") + F.col("k")).alias("depth"), "length", "a", "b", "chars")
    links = lent.unionByName(kept)
    links = materialize(links.select("conv_id", "range", "depth", "length", "chars", *(F.xxhash64(F.lit(k), "depth", "a", "b").alias(f"g{k}") for k in (1, 2))), "links")
    inside = Window.partitionBy("conv_id", "range").orderBy("depth").rowsBetween(Window.unboundedPreceding, 0)
    before = carried(links, {f"h{k}": F.bit_xor(f"g{k}") for k in (1, 2)})
    sums = {f"h{k}": F.bit_xor(f"g{k}").over(inside) for k in (1, 2)}
    chains = links.withColumns(sums).join(before, ["conv_id", "range"]).withColumns({f"h{k}": F.col(f"h{k}").bitwiseXOR(F.coalesce(f"carry_h{k}", F.lit(0))) for k in (1, 2)})
    chains = chains.select("conv_id", "range", "depth", "length", "chars", "h1", "h2", *(F.col(f"h{k}").bitwiseXOR(F.col(f"g{k}")).alias(f"q{k}") for k in (1, 2)))
    return materialize(chains, "chains"), convs.select("conv_id", "length")


def nodes_of(chains: DataFrame, root_conv: int | None, part_rows: int, levels: int) -> DataFrame:
    """The trie's nodes below the root, with members, children, the parent's conv_id, and where the trie is cut.

    A node's weight is the number of turns in and below it. It is cut on level l (the lowest of its edges gone) where its weight reaches a
    multiple of ``part_rows`` ** l that no child's weight reaches; from a top to the cut below it weights share a quotient, so what lies
    between them, all lighter branches included, weighs less than ``part_rows`` ** l. ``cut`` is the highest such level, ``start`` the
    parent's."""
    weight = F.sum(F.col("length") - F.col("depth") + 1).alias("weight")
    nodes = chains.groupBy(*NODE).agg(F.min("conv_id").alias("node_id"), F.count(F.lit(1)).alias("n_convs"), F.max("chars").alias("chars"), F.min("q1").alias("q1"), F.min("q2").alias("q2"), weight)
    nodes = materialize(nodes.withColumn("q0", F.col("depth") - 1), "nodes")
    below = nodes.groupBy(*(F.col(q).alias(n) for q, n in zip(PARENT, NODE, strict=True))).agg(F.count(F.lit(1)).alias("n_children"), F.max("weight").alias("child_weight"))
    quotient = lambda c, k: F.floor(F.col(c) / part_rows**k)
    cut = F.lit(0)
    for k in range(1, levels):
        cut = F.when((quotient("weight", k) >= 1) & (quotient("weight", k) > F.coalesce(quotient("child_weight", k), F.lit(-1))), k).otherwise(cut)
    nodes = materialize(nodes.join(below, NODE, "left").withColumn("cut", cut).withColumn("n_children", F.coalesce("n_children", F.lit(0).cast("long"))).drop("weight", "child_weight"), "nodes")
    above = nodes.where("n_children > 0").select(*(F.col(n).alias(q) for n, q in zip(NODE, PARENT, strict=True)), "n_children", F.col("node_id").alias("parent_conv_id"), F.col("cut").alias("start"))
    deep = join_counted(nodes.where("depth > 1").withColumnRenamed("n_children", "own_children"), above, PARENT, "n_children").drop("n_children").withColumnRenamed("own_children", "n_children")
    first = nodes.where("depth = 1").withColumns({"parent_conv_id": F.lit(root_conv).cast("long"), "start": F.lit(levels)})
    return materialize(deep.unionByName(first), "nodes")


def with_tops(chains: DataFrame, nodes: DataFrame, levels: int) -> DataFrame:
    """Adds to each node the top of its part on every level: the last start on the way to it, which is a running maximum in a conversation."""
    rows = join_counted(chains.select("conv_id", "range", *NODE), nodes.select(*NODE, "n_convs", "node_id", "start"), NODE, "n_convs")
    rows = materialize(rows.select("conv_id", "range", *NODE, "start", (F.col("conv_id") == F.col("node_id")).alias("own")), "starts")
    inside = Window.partitionBy("conv_id", "range").orderBy("depth").rowsBetween(Window.unboundedPreceding, 0)
    starts = {f"top{k}": F.max(F.when(F.col("start") >= k, key())) for k in range(1, levels + 1)}
    before = carried(rows, starts)
    tops = rows.withColumns({n: c.over(inside) for n, c in starts.items()}).join(before, ["conv_id", "range"])
    tops = tops.where("own").select(*NODE, *(F.coalesce(n, f"carry_{n}").alias(n) for n in starts))
    return nodes.join(tops, NODE)


def totals(units: DataFrame, names: list[str], level: int, levels: int, part_rows: int) -> DataFrame:
    """(NODE and ``names``): the sums of ``names`` over each unit's subtree. A unit is a node or, on higher levels, a part with a cut.

    Parts without a cut are added to the unit they hang on; parts with one are the units of the next level, which gives their totals. What
    hangs below a cut then enters the part at the cut, and every part is decomposed by itself."""
    top = f"top{level}"
    if level < levels:
        cut = F.max(F.when(F.col("cut") >= level, F.struct(*NODE, "cut", *(f"top{k}" for k in range(level + 1, levels + 1))))).alias("c")
        own = units.groupBy(top).agg(*(F.sum(n).alias(n) for n in names), cut, F.min(F.struct("depth", *PARENT)).alias("first"))
        own = materialize(own, "parts")
        hung = own.where("c IS NULL").groupBy(*(F.col(f"first.{q}").alias(n) for q, n in zip(PARENT, NODE, strict=True))).agg(*(F.sum(n).alias(f"hung_{n}") for n in names))
        whole = own.where("c IS NOT NULL").select("c.*", *(f"first.{q}" for q in PARENT), *names)
        above = whole.join(hung, NODE, "left").withColumns({n: F.col(n) + F.coalesce(f"hung_{n}", F.lit(0)) for n in names}).drop(*(f"hung_{n}" for n in names))
        found = totals(materialize(above, "units"), names, level + 1, levels, part_rows)
        more = found.join(whole.select(*NODE, *(F.col(n).alias(f"own_{n}") for n in names)), NODE).select(*NODE, *((F.col(n) - F.col(f"own_{n}")).alias(f"more_{n}") for n in names))
        units = units.join(more, NODE, "left").withColumns({n: F.col(n) + F.coalesce(f"more_{n}", F.lit(0)) for n in names})

    schema = pa.schema([(n, pa.int64()) for n in [*NODE, *names]])

    def decomposed(group: pa.Table) -> pa.Table:
        """Whole parts; a parent counts only where it lies in the same part."""
        columns = {n: group.column(n).to_pylist() for n in group.column_names}
        order = sorted(range(group.num_rows), key=columns["depth"].__getitem__)
        at = lambda keys: zip(columns["part"], *(columns[k] for k in keys), strict=True)
        units = list(at(NODE))
        place = {units[i]: k for k, i in enumerate(order)}
        parents = list(at(PARENT))
        sums = rollup([place.get(parents[i], -1) for i in order], [[columns[n][i] for i in order] for n in names])
        return pa.table([*([columns[n][i] for i in order] for n in NODE), *sums], schema=schema)

    buckets = 1 + units.count() // part_rows
    part = F.concat_ws(".", *(F.col(f"{top}.{n}").cast("string") for n in NODE))
    rows = units.select(part.alias("part"), *NODE, *PARENT, *(F.col(n).cast("long").alias(n) for n in names))
    dealt = rows.groupBy(F.pmod(F.xxhash64("part"), F.lit(buckets)).alias("bucket"))
    return materialize(dealt.applyInArrow(decomposed, ", ".join(f"{n} long" for n in schema.names)), "totals")


def end_hashes(ends: DataFrame) -> DataFrame:
    """(NODE, ends_sha256): SHA-256 of each node's ids in order, comma-joined. The ids are dealt to ranges in order and joined there to chunks, so
    that the one task that hashes a node's list streams it in a row for some hundreds of ids."""
    ids = ends.repartitionByRange(*NODE, "conv_id").sortWithinPartitions(*NODE, "conv_id")

    def chunks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = [*NODE, "first", "ids"]
        open_, held, size = None, [], 0
        for batch in batches:
            out: list[tuple] = []
            for *node, conv_id in zip(*(batch.column(k).to_pylist() for k in range(4)), strict=True):
                if held and (node != open_ or size > CHUNK_CHARS):
                    out.append((*open_, int(held[0]), ",".join(held)))
                    held, size = [], 0
                open_ = node
                held.append(str(conv_id))
                size += len(held[-1]) + 1
            if out:
                yield pa.RecordBatch.from_arrays([pa.array(c) for c in zip(*out, strict=True)], names=names)
        if held:
            yield pa.RecordBatch.from_arrays([pa.array([x]) for x in (*open_, int(held[0]), ",".join(held))], names=names)

    def hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        open_, state = None, None
        for batch in batches:
            out: list[tuple] = []
            for *node, ids in zip(*(batch.column(k).to_pylist() for k in (0, 1, 2, 4)), strict=True):
                if node != open_:
                    if state:
                        out.append((*open_, state.hexdigest()))
                    open_, state = node, hashlib.sha256(ids.encode())
                else:
                    state.update(b"," + ids.encode())
            if out:
                yield pa.RecordBatch.from_arrays([pa.array(c) for c in zip(*out, strict=True)], names=[*NODE, "ends_sha256"])
        if state:
            yield pa.RecordBatch.from_arrays([pa.array([x]) for x in (*open_, state.hexdigest())], names=[*NODE, "ends_sha256"])

    longs = ", ".join(f"{n} long" for n in NODE)
    made = materialize(ids.select(*NODE, "conv_id").mapInArrow(chunks, f"{longs}, first long, ids string"), "ends")
    return made.repartition(*NODE).sortWithinPartitions(*NODE, "first").mapInArrow(hashed, f"{longs}, ends_sha256 string")


def prefix_trie(conversations: DataFrame, part_rows: int = PART_ROWS) -> DataFrame:
    """One row for each node of the trie of rebuilt conversations: conv_id (its smallest member), depth, parent_conv_id, n_convs, n_children,
    n_leaves and saved_tokens (over its subtree), ends_sha256.

    ``conversations`` has conv_id, turn, role and text. A conversation's first h turns (h from a hash of its id) are replaced by those of its
    block's first conversation (blocks of a hundred ids, from a multiple of it up, below zero too); sequences of turns that begin alike share nodes, which are told apart by 128 bits of hash. Sums over
    subtrees come from a centroid decomposition: the trie is cut into parts of ``part_rows`` turns at most by the weights of its nodes, and
    each part is decomposed by ``rollup``, on as many levels as the logarithm of all turns to the base ``part_rows``.

    Turns are in the order of turn (null first), then role, then text; null role or text is empty; rows that repeat are turns of their own;
    rows with a null conv_id belong to no conversation and are left out; very long texts count by their hash and length; a conversation
    without turns is a member of the root; without conversations there is no node; other columns are ignored."""
    chains, convs = rebuilt(turns_in_order(conversations))
    n_convs, root_conv, rows = convs.agg(F.count(F.lit(1)), F.min("conv_id"), F.sum("length")).first()
    levels = 1
    while part_rows**levels <= (rows or 0):
        levels += 1
    nodes = materialize(with_tops(chains, nodes_of(chains, root_conv, part_rows, levels), levels), "nodes")
    units = nodes.withColumns({"n_leaves": (F.col("n_children") == 0).cast("long"), "saved_tokens": (F.col("n_convs") - 1) * F.col("chars")})
    sums = totals(units.select(*NODE, *PARENT, "cut", *(f"top{k}" for k in range(1, levels + 1)), "n_leaves", "saved_tokens"), ["n_leaves", "saved_tokens"], 1, levels, part_rows)
    last = chains.where("depth = length").select("conv_id", *NODE)
    none = convs.where("length = 0").select("conv_id", *(F.lit(0).cast("long").alias(n) for n in NODE))
    ends = materialize(end_hashes(last.unionByName(none)), "end-hashes")
    below = nodes.join(sums, NODE)
    tops = below.where("depth = 1").agg(F.count(F.lit(1)).alias("n_children"), F.sum("n_leaves").alias("n_leaves"), F.sum("saved_tokens").alias("saved_tokens"))
    root = tops.where(F.lit(n_convs) > 0).select(*(F.lit(0).cast("long").alias(n) for n in NODE), F.lit(root_conv).cast("long").alias("conv_id"), F.lit(None).cast("long").alias("parent_conv_id"), F.lit(n_convs).cast("long").alias("n_convs"), "n_children", F.coalesce("n_leaves", F.lit(1)).alias("n_leaves"), F.coalesce("saved_tokens", F.lit(0)).alias("saved_tokens"))
    rows = below.select(*NODE, F.col("node_id").alias("conv_id"), "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens").unionByName(root)
    nothing = hashlib.sha256().hexdigest()
    return rows.join(ends, NODE, "left").select("conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", F.coalesce("ends_sha256", F.lit(nothing)).alias("ends_sha256"))
