"""SimHash near-duplicates by meet-in-the-middle ball hashing."""

from __future__ import annotations

import math
from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from terrasheaf.llm.common import join_counted, materialize, texts_of, with_columns
from terrasheaf.llm.components import components

BITS = 64
#: Variants that one bucket holds on average; a bucket is one group of a shuffle.
BUCKET_VARIANTS = 3_000_000


def fingerprint(text: bytes, width: int = 3, seed: int = 42) -> int:
    """A bit is set if it is set in over half the XXH64 hashes of the text's ``width``-word shingles, repeats included."""
    words = text.lower().split()  # bytes: A-Z alone is lowered, ASCII white space alone splits
    if not words:
        return 0
    joined = b" ".join(words)
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
    starts = np.concatenate([[0], ends[:-1] + 1])
    n = max(1, len(words) - width + 1)
    counts = np.zeros(BITS, np.int64)
    digest = xxhash.xxh64_intdigest
    for low in range(0, n, 100_000):
        high = min(n, low + 100_000)
        last = ends[low + width - 1 : high + width - 1] if len(words) >= width else ends[-1:]
        hashes = np.array([digest(joined[a:b], seed) for a, b in zip(starts[low:high].tolist(), last.tolist(), strict=True)], np.uint64)
        counts += np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(counts * 2 > n, bitorder="little").view(np.int64)[0])


def fingerprints(docs: DataFrame, keys: list[str], text_col: str = "text") -> DataFrame:
    """The columns ``keys`` (of numbers) and fp, the signed 64-bit fingerprint of every whole text; 0 for null or wordless text."""
    schema = pa.schema([(k, pa.int64()) for k in [*keys, "fp"]])

    def hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield with_columns(batch, keys, schema, 0, batch.num_rows, fp=[fingerprint(t) for t in texts_of(batch, "__text")])

    rows = docs.select(*(F.col(k).cast("long").alias(k) for k in keys), F.col(text_col).cast("string").alias("__text"))
    return rows.mapInArrow(hashed, ", ".join(f"`{k}` long" for k in [*keys, "fp"]))


def ball(radius: int) -> np.ndarray:
    """All masks with at most ``radius`` bits."""
    masks = [sum(1 << b for b in bits) for r in range(radius + 1) for bits in combinations(range(BITS), r)]
    return np.array(masks, np.uint64)


def bucket_rows(count: int) -> list[int]:
    """The rows of a random matrix over GF(2) that sends a variant to one of 2 ** count buckets; as it is linear, a bucket of
    fingerprint ^ mask is the bucket of the fingerprint ^ the bucket of the mask."""
    return [int(x) for x in np.random.default_rng(7).integers(1, 2**63 - 1, count)]


def bucket_of(values: np.ndarray, rows: list[int]) -> np.ndarray:
    out = np.zeros(len(values), np.int64)
    for j, row in enumerate(rows):
        out |= (np.bitwise_count(values & np.uint64(row)).astype(np.int64) & 1) << j
    return out


def bucket_column(fp: Column, rows: list[int]) -> Column:
    out = F.lit(0).cast("long")
    for j, row in enumerate(rows):
        out = out + F.shiftleft((F.bit_count(fp.bitwiseAND(F.lit(row))) % 2).cast("long"), j)
    return out


def forest(n: int, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """For nodes 0 to n - 1 and links (a, b), the smallest node of each one's component."""
    root = np.arange(n)
    while True:
        low = np.minimum(root[a], root[b])
        new = root.copy()
        np.minimum.at(new, root[a], low)
        np.minimum.at(new, root[b], low)
        while not np.array_equal(new, hop := new[new]):
            new = hop
        if np.array_equal(new, root):
            return root
        root = new


def radii(radius: int) -> tuple[int, int]:
    """How far fingerprints of even and of odd parity emit. Two at an odd distance differ in parity, so their radii need to add up to
    ``radius``; two at an even distance have the same, and the smaller radius twice reaches all even distances below ``radius`` + 1."""
    if radius % 2 == 0:
        return radius // 2, radius // 2
    return radius // 2, radius // 2 + 1


def meet(fps: np.ndarray, bucket: int, rows: list[int], radius: int) -> tuple[np.ndarray, np.ndarray]:
    """Links (by position in ``fps``) between fingerprints that share a variant in this bucket and differ in ``radius`` bits at most.

    Per shared variant, all that share it are linked to one that emits it from within the smaller radius; where there is none, its pairs
    of the given distance meet at another variant. So a variant gives links in proportion to those who share it, not to their pairs.
    """
    small, large = radii(radius)
    masks = ball(large)
    weight = np.bitwise_count(masks)
    mask_bucket = bucket_of(masks, rows)
    order = np.argsort(mask_bucket, kind="stable")
    masks, weight, mask_bucket = masks[order], weight[order], mask_bucket[order]
    wanted = bucket_of(fps, rows) ^ bucket
    odd = (np.bitwise_count(fps) & 1).astype(bool)
    low, high = np.searchsorted(mask_bucket, wanted, "left"), np.searchsorted(mask_bucket, wanted, "right")
    width = high - low
    # 32-bit positions, and no more than a few arrays of the variants' number at a time
    who = np.repeat(np.arange(len(fps), dtype=np.int32), width)
    at = np.arange(len(who), dtype=np.int32)
    at -= np.repeat((np.cumsum(width) - width - low).astype(np.int32), width)
    near = weight[at] <= small
    keep = near | odd[who]
    who, at, near = who[keep], at[keep], near[keep]
    variants = fps[who]
    variants ^= masks[at]
    del at, keep
    order = np.argsort(variants)
    variants, who, near = variants[order], who[order], near[order]
    del order
    if not len(variants):
        return who, who
    new = np.concatenate([[True], variants[1:] != variants[:-1]])
    starts = np.flatnonzero(new)
    sizes = np.diff(np.concatenate([starts, [len(variants)]]))
    leader = np.minimum.reduceat(np.where(near, who, len(fps)), starts)
    of = np.repeat(leader, sizes)
    linked = (np.repeat(sizes, sizes) > 1) & (of < len(fps)) & (of != who)
    a, b = of[linked], who[linked]
    true = np.bitwise_count(fps[a] ^ fps[b]) <= radius
    return a[true], b[true]


def links(classes: DataFrame, radius: int = 3) -> DataFrame:
    """Links (a, b) that connect all distinct fingerprints ``fp`` at ``radius`` or fewer differing bits: a spanning forest per bucket.

    Every fingerprint emits all variants within half the radius (rounded down or, for odd parity, up). The shuffle is on variants: a linear
    hash groups variants in buckets of about ``BUCKET_VARIANTS``, a fingerprint travels once to each bucket that one of its variants falls
    in, and the bucket's task forms those variants again, sorts them and verifies what collides.
    """
    count = classes.count()
    small, large = radii(radius)
    sizes = [sum(math.comb(BITS, r) for r in range(x + 1)) for x in (small, large)]
    bits = max(1, math.ceil(math.log2(max(1, count * sum(sizes) / 2 / BUCKET_VARIANTS))))
    rows = bucket_rows(bits)
    steps = [sorted(set(bucket_of(ball(x), rows).tolist())) for x in (small, large)]
    home = bucket_column(F.col("fp"), rows)
    which = F.when(F.bit_count("fp") % 2 == 0, F.array(*map(F.lit, steps[0]))).otherwise(F.array(*map(F.lit, steps[1])))
    sent = classes.select("fp", F.explode(which).alias("step"), home.alias("home")).select("fp", F.col("home").bitwiseXOR(F.col("step")).alias("bucket"))

    def in_bucket(key: tuple[pa.Scalar, ...], group: pa.Table) -> pa.Table:
        fps = np.unique(group.column("fp").to_numpy()).view(np.uint64)
        a, b = meet(fps, key[0].as_py(), rows, radius)
        root = forest(len(fps), a, b)
        moved = np.flatnonzero(root != np.arange(len(fps)))
        signed = fps.view(np.int64)
        return pa.table({"a": signed[root[moved]], "b": signed[moved]})

    return sent.groupBy("bucket").applyInArrow(in_bucket, "a long, b long")


def near_classes(classes: DataFrame, radius: int) -> DataFrame:
    """Adds ``root``, the same for all fingerprints ``fp`` of a component, to a stored table of distinct fingerprints."""
    roots = materialize(components(links(classes.select("fp"), radius)).select(F.col("node").alias("fp"), "root"), "roots")
    return classes.join(roots, "fp", "left").withColumn("root", F.coalesce("root", "fp"))


def near_duplicates(docs: DataFrame, radius: int = 3, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, fingerprint (16 hex digits) and component_id, the smallest doc_id that links of ``radius`` or fewer bits reach.

    Equal fingerprints form one class first, so copies cost one group-by; only classes are compared. Null or wordless text has fingerprint
    zero and is linked like any other; rows with a null id belong to their component but never name it (a component of such rows alone has
    a null id); repeated rows stay; no rows give no rows; other columns are ignored. Fingerprints and components that a large share of
    all rows have are joined without a shuffle.
    """
    printed = materialize(fingerprints(docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text")), ["doc_id"]), "fingerprints")
    classes = materialize(printed.groupBy("fp").agg(F.min("doc_id").alias("least"), F.count(F.lit(1)).alias("n")), "classes")
    rooted = materialize(near_classes(classes, radius), "rooted")
    names = materialize(rooted.groupBy("root").agg(F.min("least").alias("component_id"), F.count(F.lit(1)).alias("n_classes")), "names")
    named = materialize(join_counted(rooted.select("fp", "n", "root"), names, "root", "n_classes").select("fp", "n", "component_id"), "components")
    return join_counted(printed, named, "fp", "n").select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def representatives(docs: DataFrame, radius: int = 3, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row of each group of near-duplicates, with all columns of ``docs``: the one with the smallest id, a null id last, and of those
    with that id the one with the smallest hash of all its columns.

    Rows are told apart by all their columns and not by their ids, so equal or null ids lose no text that has no near-duplicate, and the
    outcome does not depend on the order of rows. Null or wordless texts are one group; of rows that are alike in all columns one is
    left; no rows give no rows.
    """
    whole = F.concat(*(F.concat(F.coalesce(F.length(c).cast("string"), F.lit("null")), F.lit(":"), F.coalesce(c, F.lit(""))) for c in (F.col(f"`{n}`").cast("string") for n in docs.columns)))
    keyed = docs.withColumns({"__k1": F.xxhash64(F.lit(1), whole), "__k2": F.xxhash64(F.lit(2), whole)})
    printed = fingerprints(keyed.select(F.col(id_col).alias("doc_id"), "__k1", "__k2", F.col(text_col).alias("text")), ["doc_id", "__k1", "__k2"])
    first = F.min(F.struct(F.col("doc_id").isNull().alias("unnamed"), "doc_id", "__k1", "__k2")).alias("first")
    classes = materialize(printed.groupBy("fp").agg(first), "classes")
    chosen = near_classes(classes, radius).groupBy("root").agg(F.min("first").alias("first")).select("first.__k1", "first.__k2")
    return keyed.dropDuplicates(["__k1", "__k2"]).join(materialize(chosen, "chosen"), ["__k1", "__k2"], "left_semi").select(*docs.columns)
