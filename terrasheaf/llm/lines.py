"""Lines that many documents share, found with two Bloom filters: of lines seen once and of lines seen twice."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from terrasheaf.llm.common import SharedFiles, parts_of, runs, scratch_path, texts_of, with_columns

WHITE = b" \t\n\r\x0b\x0c"
#: A filter is cut into segments of so many bits, each a file; a key's bits lie in one block of a segment, which is a page of memory.
SEGMENT_BITS, BLOCK_BITS = 24, 15
BITS_PER_LINE, PROBES = 8, 4
#: Lines that a task holds before it sends what it knows of them on, or asks the filter for them.
FLUSH = 1_000_000
PIECE_SCHEMA = "segment long, once binary, twice binary"


def line_keys(text: bytes) -> list[bytes]:
    """Each line's key: ASCII white space at both ends gone and A-Z lower-cased."""
    return [line.strip(WHITE) for line in text.lower().split(b"\n")]


def digests(keys: list[bytes]) -> np.ndarray:
    """128 bits for each key, as two numbers."""
    return np.frombuffer(b"".join(map(xxhash.xxh3_128_digest, keys)), ">u8").reshape(-1, 2).astype(np.uint64)


def long_enough(keys: list[bytes], least: int) -> list[bool]:
    if least <= 1:
        return [bool(k) or not least for k in keys]
    return [len(k) >= least and len(k.decode()) >= least for k in keys]


def spots(hashes: np.ndarray, segments: int) -> tuple[np.ndarray, np.ndarray]:
    """The segment of each hash and its ``PROBES`` places there."""
    a, b = hashes[:, 0], hashes[:, 1]
    segment = ((a >> np.uint64(32)) * np.uint64(segments)) >> np.uint64(32)
    block = (a & np.uint64((1 << SEGMENT_BITS - BLOCK_BITS) - 1)) << np.uint64(BLOCK_BITS)
    places = np.stack([b >> np.uint64(BLOCK_BITS * k) for k in range(PROBES)], 1) & np.uint64((1 << BLOCK_BITS) - 1)
    return segment.astype(np.int64), (block[:, None] + places).astype(np.int64)


def packed_places(places: np.ndarray) -> bytes:
    """Sorted places as differences whose bytes are transposed for the shuffle's compression, after a 0; as bits, after a 1, if that is shorter."""
    if len(places) > 1 << SEGMENT_BITS - 5:
        bits = np.zeros(1 << SEGMENT_BITS, bool)
        bits[places] = True
        return b"\1" + np.packbits(bits, bitorder="little").tobytes()
    return b"\0" + np.diff(places, prepend=0).astype("<u4").view(np.uint8).reshape(-1, 4).T.tobytes()


def places_of(data: bytes) -> np.ndarray:
    if data[:1] == b"\1":
        return np.flatnonzero(np.unpackbits(np.frombuffer(data, np.uint8, offset=1), bitorder="little"))
    return np.cumsum(np.ascontiguousarray(np.frombuffer(data, np.uint8, offset=1).reshape(4, -1).T).view("<u4").ravel(), dtype=np.int64)


def pieces(hashes: np.ndarray, segments: int) -> pa.RecordBatch:
    """For each segment the places of a task's keys and of those that it has seen in two documents or more."""
    hashes = hashes[np.lexsort((hashes[:, 1], hashes[:, 0]))]
    new = np.concatenate([[True], (hashes[1:] != hashes[:-1]).any(1)])
    starts = np.flatnonzero(new)
    again = np.diff(np.append(starts, len(hashes))) > 1
    segment, places = spots(hashes[starts], segments)
    out: dict[int, list[bytes]] = {}
    for k, mine in enumerate((np.ones(len(starts), bool), again)):
        flat = np.unique((segment[mine, None] << SEGMENT_BITS | places[mine]).ravel())
        owner = flat >> SEGMENT_BITS
        for s in np.unique(owner).tolist():
            low, high = np.searchsorted(owner, [s, s + 1])
            out.setdefault(s, [packed_places(np.zeros(0, np.int64))] * 2)[k] = packed_places(flat[low:high] & (1 << SEGMENT_BITS) - 1)
    names = list(out)
    return pa.RecordBatch.from_arrays([pa.array(names, pa.int64()), *(pa.array([out[s][k] for s in names], pa.binary()) for k in (0, 1))], names=["segment", "once", "twice"])


class Filter:
    """The filter of keys seen twice, in files of the shared folder, and beside them the keys that are confirmed."""

    def __init__(self, uri: str, segments: int):
        self.files, self.segments = SharedFiles(uri), segments

    def suspects(self, hashes: np.ndarray) -> np.ndarray:
        """Which hashes may have been seen twice, the files asked one after the other."""
        out = np.zeros(len(hashes), bool)
        segment, places = spots(hashes, self.segments)
        for k, mine in parts_of(segment):
            bits = self.files.read(f"twice-{k}")
            at = places[mine]
            out[mine] = ((bits[at >> 3] >> (at & 7).astype(np.uint8)) & 1).all(1)
        return out

    def confirmed(self, hashes: np.ndarray) -> np.ndarray:
        """For each hash its row among the confirmed keys of its segment, or -1, with the first occurrence: (found, first id, first line, unnamed)."""
        out = np.full((len(hashes), 4), -1, np.int64)
        asked = np.flatnonzero(self.suspects(hashes))
        for k, at in parts_of(spots(hashes[asked], self.segments)[0]):
            mine = asked[at]
            table = self.files.read(f"keys-{k}").view("<i8").reshape(5, -1)
            known, want = table[0].view("<u8"), hashes[mine]
            at, end = np.searchsorted(known, want[:, 0]), np.searchsorted(known, want[:, 0], "right")
            hit = np.full(len(mine), -1)
            while (open_ := at < end).any():  # keys with equal first halves, of which there is hardly ever more than one
                same = open_ & (table[1].view("<u8")[np.minimum(at, len(known) - 1)] == want[:, 1])
                hit[same] = at[same]
                at = at + 1
            found = hit >= 0
            out[mine[found]] = np.stack([hit[found], table[2][hit[found]], table[3][hit[found]], table[4][hit[found]]], 1)
        return out


def build_filter(texts: DataFrame, least: int, segments: int | None = None) -> Filter:
    """The filter of keys that two documents or more hold, from ``texts`` (column text), with ``BITS_PER_LINE`` for each line.

    Each task sends the places of its keys, and those of keys it has met twice, by segments; a segment's task joins them: a place that comes
    again, or is sent as twice, is one of the second filter. Lines themselves are not shuffled."""
    spark = texts.sparkSession
    if segments is None:
        n_lines = F.sum(F.octet_length("text").cast("long") - F.octet_length(F.regexp_replace("text", "\n", "")) + 1)
        segments = 1 + ((texts.agg(n_lines).first()[0] or 0) * BITS_PER_LINE >> SEGMENT_BITS)
    made = Filter(scratch_path(spark, "line-filter"), segments)

    def seen(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[np.ndarray] = []
        size = 0
        for batch in batches:
            for text in texts_of(batch, "text"):
                keys = list(set(line_keys(text)))
                keys = [k for k, ok in zip(keys, long_enough(keys, least), strict=True) if ok]
                if keys:
                    held.append(digests(keys))
                    size += len(keys)
                if size >= FLUSH:
                    yield pieces(np.concatenate(held), segments)
                    held, size = [], 0
        if size:
            yield pieces(np.concatenate(held), segments)

    def joined(key: tuple[pa.Scalar, ...], group: pa.Table) -> pa.Table:
        once, twice = np.zeros(1 << SEGMENT_BITS, bool), np.zeros(1 << SEGMENT_BITS, bool)
        for a, b in zip(group.column("once"), group.column("twice"), strict=True):
            places = places_of(a.as_py())
            twice[places[once[places]]] = True
            once[places] = True
            twice[places_of(b.as_py())] = True
        made.files.write(f"twice-{key[0].as_py()}", np.packbits(twice, bitorder="little").tobytes())
        return pa.table({"places": pa.array([int(twice.sum())], pa.int64())})

    none = f"unhex('{packed_places(np.zeros(0, np.int64)).hex()}')"
    empty = spark.range(segments).selectExpr("id as segment", f"{none} as once", f"{none} as twice")
    texts.mapInArrow(seen, PIECE_SCHEMA).unionByName(empty).groupBy("segment").applyInArrow(joined, "places long").agg(F.sum("places")).first()
    return made


def confirm(rows: DataFrame, made: Filter, least: int, min_docs: int) -> None:
    """Counts the documents of each suspected key (``rows``: doc_id, text) and stores the keys that ``min_docs`` or more hold, with their first
    occurrence. A task sums up what it sends, so a key that all documents hold is a row for each task."""

    def suspected(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple[np.ndarray, np.ndarray]] = []
        size = 0

        def summed() -> pa.RecordBatch:
            hashes, where = (np.concatenate(x) for x in zip(*held, strict=True))
            hit = made.suspects(hashes)
            hashes, where = hashes[hit], where[hit]
            order = np.lexsort((where[:, 2], where[:, 1], where[:, 0], hashes[:, 1], hashes[:, 0]))
            hashes, where = hashes[order], where[order]
            starts = np.flatnonzero(np.concatenate([[True], (hashes[1:] != hashes[:-1]).any(1)])) if len(hashes) else np.zeros(0, np.int64)
            columns = [hashes[starts, 0].view(np.int64), hashes[starts, 1].view(np.int64), np.diff(np.append(starts, len(hashes))), *where[starts].T]
            return pa.RecordBatch.from_arrays([pa.array(np.ascontiguousarray(c), pa.int64()) for c in columns], names=["a", "b", "n", "unnamed", "first_id", "first_line"])

        for batch in batches:
            for doc_id, text in zip(batch.column(0).to_pylist(), texts_of(batch, "text"), strict=True):
                first: dict[bytes, int] = {}
                for k, key in enumerate(line_keys(text)):
                    first.setdefault(key, k)
                keys = [k for k, ok in zip(first, long_enough(list(first), least), strict=True) if ok]
                if keys:
                    where = np.zeros((len(keys), 3), np.int64)
                    where[:, 0], where[:, 1], where[:, 2] = doc_id is None, doc_id or 0, [first[k] for k in keys]
                    held.append((digests(keys), where))
                    size += len(keys)
                if size >= FLUSH:
                    yield summed()
                    held, size = [], 0
        if size:
            yield summed()

    def written(key: tuple[pa.Scalar, ...], group: pa.Table) -> pa.Table:
        a, b, *rest = (group.column(n).to_numpy() for n in ("a", "b", "first_id", "first_line", "unnamed"))
        real = ~np.isnan(group.column("n").to_numpy().astype(float))
        order = np.lexsort((b.view(np.uint64), a.view(np.uint64)))
        order = order[real[order]]
        made.files.write(f"keys-{key[0].as_py()}", np.stack([c[order] for c in (a, b, *rest)]).astype("<i8").tobytes())
        return pa.table({"keys": pa.array([len(order)], pa.int64())})

    schema = "a long, b long, n long, unnamed long, first_id long, first_line long"
    counts = rows.mapInArrow(suspected, schema).groupBy("a", "b").agg(F.sum("n").alias("n"), F.min(F.struct("unnamed", "first_id", "first_line")).alias("first")).where(F.col("n") >= min_docs)
    segment = F.shiftright(F.shiftrightunsigned("a", 32) * made.segments, 32)
    keyed = counts.select(segment.alias("segment"), "a", "b", "n", "first.*")
    zero = F.lit(0).cast("long")
    empty = rows.sparkSession.range(made.segments).select(F.col("id").alias("segment"), zero.alias("a"), zero.alias("b"), F.lit(None).cast("long").alias("n"), *(zero.alias(c) for c in ("unnamed", "first_id", "first_line")))
    keyed.unionByName(empty).groupBy("segment").applyInArrow(written, "keys long").agg(F.sum("keys")).first()


def drop_shared_lines(docs: DataFrame, min_docs: int = 10, min_chars: int = 1, keep_first: bool = False, id_col: str = "doc_id", text_col: str = "text", segments: int | None = None) -> DataFrame:
    """doc_id, n_lines, n_dropped and the text without the lines whose key (white space at both ends gone, A-Z lower-cased) has ``min_chars`` code
    points or more and is found in ``min_docs`` documents or more. With ``keep_first`` the key's first occurrence (smallest id, a null id last,
    then smallest line number) stays.

    Three passes over the texts: the two filters; the suspected keys, which alone are shuffled and counted exactly, as 128-bit hashes; and the
    lines that go. Each row is a document, so a row that repeats counts as often; where ids repeat all rows of the first id keep the first
    line. Null or empty text is one empty line and stays empty; lines that were white space stay as they are; very long texts are handled
    whole, a text at a time; no rows give no rows; other columns are ignored.
    """
    if min_docs < 2:
        raise ValueError("a shared line is in two documents or more")
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    made = build_filter(rows.select("text"), min_chars, segments)
    confirm(rows, made, min_chars, min_docs)
    schema = pa.schema([("doc_id", pa.int64()), ("n_lines", pa.int64()), ("n_dropped", pa.int64()), ("text", pa.string())])

    def without(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts, ids = texts_of(batch, "text"), batch.column(0).to_pylist()
            for start, end in runs(texts, 16 << 20):
                keys = [line_keys(t) for t in texts[start:end]]
                counts = [len(k) for k in keys]
                flat = [x for k in keys for x in k]
                mine = np.flatnonzero(long_enough(flat, min_chars))
                gone = np.zeros(len(flat), bool)
                if len(mine):
                    known = made.confirmed(digests([flat[i] for i in mine]))
                    lost = known[:, 0] >= 0
                    if keep_first:
                        lines = np.concatenate([np.arange(n) for n in counts])[mine]
                        own = np.repeat([-1 if i is None else i for i in ids[start:end]], counts)[mine]
                        unnamed = np.repeat([i is None for i in ids[start:end]], counts)[mine]
                        lost &= ~((known[:, 3] == unnamed) & (unnamed | (known[:, 1] == own)) & (known[:, 2] == lines))
                    gone[mine] = lost
                kept, dropped, at = [], [], 0
                for text, n in zip(texts[start:end], counts, strict=True):
                    drop = gone[at : at + n]
                    at += n
                    dropped.append(int(drop.sum()))
                    kept.append(b"\n".join(x for x, d in zip(text.split(b"\n"), drop.tolist(), strict=True) if not d) if dropped[-1] else text)
                yield with_columns(batch, ["doc_id"], schema, start, end, n_lines=counts, n_dropped=dropped, text=kept)

    return rows.mapInArrow(without, "doc_id long, n_lines long, n_dropped long, text string")
