"""Packing of tokenised documents into sequences of near-equal length by Karmarkar-Karp multiway differencing."""

from __future__ import annotations

import heapq
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from terrasheaf.llm.common import texts_of
from terrasheaf.llm.tokens import word_ids

#: Windows that are balanced against each other, and the share of them that a group leaves free, so that the first try has room to succeed.
GROUP_WINDOWS = 64
FREE_SHARE = 1 / 64


def difference(sizes: list[int], k: int) -> list[list[int]]:
    """Items dealt into ``k`` windows by the largest differencing method: the two partial partitions with the largest spread are merged, the
    fullest windows of one with the emptiest of the other, until one is left."""
    heap = []
    for i, size in enumerate(sizes):
        sums = np.zeros(k, np.int64)
        sums[0] = size
        heap.append((-size, i, sums, [[i]] + [[] for _ in range(k - 1)]))
    heapq.heapify(heap)
    made = len(sizes)
    while len(heap) > 1:
        _, _, a, mine = heapq.heappop(heap)
        _, _, b, theirs = heapq.heappop(heap)
        sums = a + b[::-1]
        order = np.argsort(-sums, kind="stable")
        sums = sums[order]
        both = [x + y for x, y in zip(mine, reversed(theirs), strict=True)]
        heapq.heappush(heap, (-int(sums[0] - sums[-1]), made, sums, [both[j] for j in order]))
        made += 1
    return heap[0][3] if heap else [[] for _ in range(k)]


def windows(sizes: list[int], capacity: int) -> list[list[int]]:
    """Windows of ``capacity`` at most; their count starts at the least possible and rises while a window is over capacity."""
    k = max(1, -(-sum(sizes) // capacity))
    while True:
        found = difference(sizes, k)
        if all(sum(sizes[i] for i in w) <= capacity for w in found):
            return [w for w in found if w]
        k += 1


class Packer:
    """Collects a task's pieces and packs them a group at a time, so that a task holds the ids of one group and one document at most."""

    def __init__(self, capacity: int, first_sequence: int):
        self.capacity, self.next_sequence = capacity, first_sequence
        self.target = GROUP_WINDOWS * (capacity - int(capacity * FREE_SHARE))
        self.open: list[tuple[int | None, int, np.ndarray, int]] = []
        self.filled = 0

    def add(self, doc_id: int | None, ids: np.ndarray) -> Iterator[tuple]:
        """Cuts whole sequences off a document, and what is left at the end of a group."""
        start, total = 0, len(ids)
        while total - start >= self.capacity:
            yield self.row(doc_id, start, ids[start : start + self.capacity], total, self.next_sequence, 0)
            self.next_sequence += 1
            start += self.capacity
        while start < total:
            piece = ids[start : start + self.target - self.filled]
            self.open.append((doc_id, start, piece, total))
            self.filled += len(piece)
            start += len(piece)
            if self.filled == self.target:
                yield from self.close()

    def bundles(self) -> list[list[int]]:
        """The open pieces as items to deal: pieces of less than a part in ``GROUP_WINDOWS`` of a window join others of their kind up to that size,
        so a group has ``GROUP_WINDOWS`` squared items and some, however small its pieces are."""
        least = self.capacity // GROUP_WINDOWS
        out, small, size = [], [], 0
        for i, (_, _, ids, _) in enumerate(self.open):
            if len(ids) >= least:
                out.append([i])
                continue
            if small and size + len(ids) > least:
                out.append(small)
                small, size = [], 0
            small.append(i)
            size += len(ids)
        return out + [small] * bool(small)

    def close(self) -> Iterator[tuple]:
        items = self.bundles()
        for window in windows([sum(len(self.open[i][2]) for i in item) for item in items], self.capacity):
            offset = 0
            for i in sorted(i for k in window for i in items[k]):
                doc_id, start, piece, total = self.open[i]
                yield self.row(doc_id, start, piece, total, self.next_sequence, offset)
                offset += len(piece)
            self.next_sequence += 1
        self.open, self.filled = [], 0

    @staticmethod
    def row(doc_id, start, ids, total, sequence, offset) -> tuple:
        return doc_id, start, len(ids), zlib.crc32(ids.astype("<u4").tobytes()), total, sequence, offset, ids.astype(np.int32)


FIELDS = ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"]


def pack(docs: DataFrame, tokenizer_path: str, capacity: int = 4096, end_id: int = 2, id_col: str = "doc_id", text_col: str = "text", with_ids: bool = True) -> DataFrame:
    """Pieces of documents in sequences of at most ``capacity`` tokens: doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset and
    (``with_ids``) the ids themselves.

    Every partition of ``docs`` packs its own documents in one pass, without a shuffle: documents of a sequence or more are cut, the rest
    is dealt in groups of ``GROUP_WINDOWS`` windows by differencing. A sequence id holds the partition's number in its upper 31 bits.
    A null or empty text is its end id alone; a null id stays; repeated rows are packed once each; no rows give no rows; other columns
    are ignored. A lost task packs the same rows again if ``docs`` gives a partition's rows in a stable order, as files do.
    """
    names = FIELDS + ["ids"] * with_ids
    schema = pa.schema([(n, pa.list_(pa.int32()) if n == "ids" else pa.int64()) for n in names])

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = word_ids(tokenizer_path)
        packer = Packer(capacity, TaskContext.get().partitionId() << 32)
        rows: list[tuple] = []
        size = 0

        def batch_of() -> pa.RecordBatch:
            columns = list(zip(*rows, strict=True))
            return pa.RecordBatch.from_arrays([pa.array(columns[i], schema.field(i).type) for i in range(len(names))], schema=schema)

        end = np.array([end_id], np.uint16)
        for batch in batches:
            for doc_id, text in zip(batch.column(0).to_pylist(), texts_of(batch, "text"), strict=True):
                for row in packer.add(doc_id, np.concatenate([known.ids(text), end])):
                    rows.append(row)
                    size += row[2]
                if size > 1 << 21 or len(rows) > 20_000:
                    yield batch_of()
                    rows, size = [], 0
        rows += packer.close()
        if rows:
            yield batch_of()

    given = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    return given.mapInArrow(deal, ", ".join(f"{n} {'array<int>' if n == 'ids' else 'long'}" for n in names))
