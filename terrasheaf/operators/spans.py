"""Rings as spans of cells, and what is summed over them without a row for each cell.

A span is (tile, row, low, high): the cells of one row whose centres lie between two crossings of a ring. Spans and pixels meet in blocks of
``BAND_ROWS`` rows by ``BLOCK_COLS`` columns, so what is shuffled grows with the rings' perimeters and the blocks that hold pixels.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from terrasheaf.runtime import split_crowded, stored

BAND_ROWS, BLOCK_COLS = 64, 1024
BLOCK = ["tile", "band", "block"]
#: Pixels that a task gathers before it sends their blocks on, spans of one block that a task takes, and pairs of spans or cells at a time.
FLUSH_PIXELS, BLOCK_SPANS, PAIRS = 2_000_000, 500_000, 2_000_000


def pixel_blocks(pixels: DataFrame) -> DataFrame:
    """(tile, band, block, spots, values, known): the pixels of each task and block as arrays, a cell's spot being row * BLOCK_COLS + column within
    its block; null values are not known."""

    def gathered(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size = [], 0
        for batch in batches:
            if batch.num_rows:
                held.append(batch)
                size += batch.num_rows
            if size >= FLUSH_PIXELS:
                yield packed(held)
                held, size = [], 0
        if held:
            yield packed(held)

    rows = pixels.select("tile", F.col("row").cast("long").alias("row"), F.col("col").cast("long").alias("col"), F.col("value").cast("double").alias("value"))
    tile = dict(rows.dtypes)["tile"]
    return rows.mapInArrow(gathered, f"tile {tile}, band long, block long, spots binary, values binary, known binary")


def packed(batches: list[pa.RecordBatch]) -> pa.RecordBatch:
    table = pa.Table.from_batches(batches).combine_chunks()
    tiles = table.column("tile").dictionary_encode().combine_chunks()
    row, col = table.column("row").to_numpy(), table.column("col").to_numpy()
    value = table.column("value").combine_chunks()
    known = np.asarray(value.is_valid(), np.uint8)
    values = np.asarray(value.fill_null(0.0), np.float64)
    code = np.asarray(tiles.indices.fill_null(-1), np.int64)
    band, block = row // BAND_ROWS, col // BLOCK_COLS
    spot = ((row % BAND_ROWS) * BLOCK_COLS + col % BLOCK_COLS).astype("<u4")
    order = np.lexsort((spot, block, band, code))
    ids = np.stack([code, band, block])[:, order]
    starts = np.flatnonzero(np.concatenate([[True], (ids[:, 1:] != ids[:, :-1]).any(0)]))
    cut = [order[a:b] for a, b in zip(starts, np.append(starts[1:], len(order)), strict=True)]
    arrays = [tiles.dictionary.take(pa.array([None if c < 0 else c for c in ids[0, starts].tolist()], pa.int32())), pa.array(ids[1, starts]), pa.array(ids[2, starts])]
    arrays += [pa.array([x[c].tobytes() for c in cut], pa.binary()) for x in (spot, values, known)]
    return pa.RecordBatch.from_arrays(arrays, names=[*BLOCK, "spots", "values", "known"])


class Dense:
    """A block's pixels in full, with sums along each row that start at 0, so that a span's sum is the difference of two of them."""

    def __init__(self, group: pa.Table):
        spots, values, known = (np.concatenate([np.frombuffer(x.as_py(), kind) for x in group.column(n)] or [np.zeros(0, kind)]) for n, kind in (("spots", "<u4"), ("values", "<f8"), ("known", "u1")))
        self.spots, self.values, self.known = spots.astype(np.int64), values, known.astype(bool)
        shape = (BAND_ROWS, BLOCK_COLS)
        counts = np.bincount(self.spots, minlength=BAND_ROWS * BLOCK_COLS).reshape(shape)
        valid = np.bincount(self.spots[self.known], minlength=BAND_ROWS * BLOCK_COLS).reshape(shape)
        self.finite = bool(np.isfinite(values).all())
        sums = np.bincount(self.spots[self.known], values[self.known], BAND_ROWS * BLOCK_COLS).reshape(shape).astype(np.float64)
        self.sums, self.cells = sums, counts
        pad = lambda x: np.concatenate([np.zeros((BAND_ROWS, 1), x.dtype), np.cumsum(x, axis=1)], axis=1)
        self.count, self.valid, self.sum = pad(counts), pad(valid), pad(sums) if self.finite else None

    def span_counts(self, row: np.ndarray, low: np.ndarray, high: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        return self.count[row, high + 1] - self.count[row, low], self.valid[row, high + 1] - self.valid[row, low]

    def span_sums(self, row: np.ndarray, low: np.ndarray, high: np.ndarray) -> np.ndarray:
        """Two look-ups for each span; where a value is not finite, whose sums cannot be taken apart, the cells themselves."""
        if self.finite:
            return self.sum[row, high + 1] - self.sum[row, low]
        flat = np.append(self.sums.ravel(), 0.0)
        ends = np.stack([row * BLOCK_COLS + low, row * BLOCK_COLS + high + 1], 1).ravel()
        return np.add.reduceat(flat, ends)[::2]

    def span_maxima(self, row: np.ndarray, low: np.ndarray, high: np.ndarray) -> np.ndarray:
        """From a sparse table: the maxima of all stretches of 1, 2, 4 and so on cells; any span is two of them."""
        first = np.full(BAND_ROWS * BLOCK_COLS, -np.inf)
        np.maximum.at(first, self.spots[self.known], self.values[self.known])
        tables = [first.reshape(BAND_ROWS, BLOCK_COLS)]
        while 2 << (len(tables) - 1) <= BLOCK_COLS:
            last, step = tables[-1], 1 << (len(tables) - 1)
            tables.append(np.concatenate([np.maximum(last[:, :-step], last[:, step:]), last[:, -step:]], axis=1))
        table = np.stack(tables)
        k = np.frexp((high - low + 1).astype(float))[1] - 1
        return np.maximum(table[k, row, low], table[k, row, high + 1 - (1 << k)])


def in_blocks(spans: DataFrame) -> DataFrame:
    """Spans by the blocks that they cross, with their row and columns in the block."""
    rows = spans.withColumns({"band": F.floor(F.col("row") / BAND_ROWS), "block": F.explode(F.sequence(F.floor(F.col("low") / BLOCK_COLS), F.floor(F.col("high") / BLOCK_COLS)))})
    edge = F.col("block") * BLOCK_COLS
    return rows.withColumns({"__row": (F.col("row") - F.col("band") * BAND_ROWS).cast("long"), "__low": F.greatest(F.col("low") - edge, F.lit(0)).cast("long"), "__high": F.least(F.col("high") - edge, F.lit(BLOCK_COLS - 1)).cast("long")}).drop("row", "low", "high")


def met(spans: DataFrame, pixels: DataFrame, keep: list[str], tile: str) -> tuple:
    """Spans and pixels in the same blocks, as a cogrouped pair; a block that very many spans cross is split by its spans."""
    a = stored(in_blocks(spans).select(*BLOCK, "__row", "__low", "__high", *(F.col(k).alias(f"__{k}") for k in keep)), "spans")
    b = pixel_blocks(pixels)
    a, b, by = split_crowded(a, b, BLOCK, BLOCK_SPANS)
    return a.groupBy(*by).cogroup(b.groupBy(*by))


def columns_of(group: pa.Table) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    return tuple(group.column(n).to_numpy() for n in ("__row", "__low", "__high"))


def span_statistics(spans: DataFrame, pixels: DataFrame, keys: list[str], maxima: bool) -> DataFrame:
    """(keys, s, n, known, top): sum, number, number of non-null and, if asked for, maximum of the pixels in the spans, by ``keys``."""
    kinds = dict(spans.dtypes)
    own = [k for k in keys if k != "tile"]

    def summed(spans_here: pa.Table, pixels_here: pa.Table) -> pa.Table:
        dense = Dense(pixels_here)
        row, low, high = columns_of(spans_here)
        n, known = dense.span_counts(row, low, high)
        made = {"s": dense.span_sums(row, low, high), "n": n, "known": known, "top": dense.span_maxima(row, low, high) if maxima else np.full(len(row), -np.inf)}
        made["odd"] = np.isnan(made["top"])  # Arrow's maximum passes NaN over
        table = pa.table({**{k: spans_here.column("tile" if k == "tile" else f"__{k}") for k in keys}, **made}).filter(pa.array(n > 0))
        done = table.group_by(keys).aggregate([("s", "sum"), ("n", "sum"), ("known", "sum"), ("top", "max"), ("odd", "max")])
        top = pc.if_else(done.column("odd_max"), np.nan, done.column("top_max"))
        return done.rename_columns({"s_sum": "s", "n_sum": "n", "known_sum": "known"}).append_column("top", top).select([*keys, "s", "n", "known", "top"])

    schema = ", ".join(f"`{k}` {kinds[k]}" for k in keys) + ", s double, n long, known long, top double"
    parts = met(spans, pixels, own, kinds["tile"]).applyInArrow(summed, schema)
    return parts.groupBy(*keys).agg(F.sum("s").alias("s"), F.sum("n").alias("n"), F.sum("known").alias("known"), F.max("top").alias("top"))


def span_cells(spans: DataFrame, pixels: DataFrame, keep: list[str]) -> DataFrame:
    """(tile, row, col, keep, value): the pixels that lie in each span."""
    kinds, value = dict(spans.dtypes), dict(pixels.dtypes)["value"]
    own = [k for k in keep if k != "tile"]

    def found(spans_here: pa.Table, pixels_here: pa.Table) -> pa.Table:
        dense = Dense(pixels_here)
        row, low, high = columns_of(spans_here)
        order = np.argsort(dense.spots, kind="stable")
        at = dense.spots[order]
        first, last = np.searchsorted(at, row * BLOCK_COLS + low), np.searchsorted(at, row * BLOCK_COLS + high, "right")
        who = np.repeat(np.arange(len(row)), last - first)
        which = order[np.arange(len(who)) - np.repeat(np.cumsum(last - first) - (last - first), last - first) + np.repeat(first, last - first)]
        spot = dense.spots[which]
        there = pixels_here.slice(0, 1) if pixels_here.num_rows else None
        base = (there.column("band")[0].as_py() * BAND_ROWS, there.column("block")[0].as_py() * BLOCK_COLS) if there else (0, 0)
        taken = spans_here.take(pa.array(who))
        cells = {"row": base[0] + spot // BLOCK_COLS, "col": base[1] + spot % BLOCK_COLS, "value": pa.array(dense.values[which], mask=~dense.known[which])}
        return pa.table({"tile": taken.column("tile"), **{k: taken.column(f"__{k}") for k in own}, **cells})

    schema = f"tile {kinds['tile']}, " + "".join(f"`{k}` {kinds[k]}, " for k in own) + "row long, col long, value double"
    types = dict(pixels.dtypes)
    cells = met(spans, pixels, own, kinds["tile"]).applyInArrow(found, schema)
    return cells.select("tile", F.col("row").cast(types["row"]).alias("row"), F.col("col").cast(types["col"]).alias("col"), *own, F.col("value").cast(value).alias("value"))


def overlaps(row_a: np.ndarray, low_a: np.ndarray, high_a: np.ndarray, row_b: np.ndarray, low_b: np.ndarray, high_b: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """(positions in a, positions in b, cells): all spans of two lists that share cells, some millions at a time.

    A sweep over both lists in order of their first cells: of two spans that overlap the later one begins within the earlier, so those that
    begin within a span are a stretch of the other list."""
    width = 1 << 40
    start_a, end_a, start_b, end_b = row_a * width + low_a, row_a * width + high_a, row_b * width + low_b, row_b * width + high_b
    for here, there, flipped in (((start_a, end_a), start_b, False), ((start_b, end_b), start_a, True)):
        order = np.argsort(there, kind="stable")
        sorted_ = there[order]
        first, last = np.searchsorted(sorted_, here[0], "right" if flipped else "left"), np.searchsorted(sorted_, here[1], "right")
        last = np.maximum(first, last)
        total = np.cumsum(last - first)
        low = 0
        while low < len(total):
            done = total[low - 1] if low else 0
            high = max(low + 1, int(np.searchsorted(total, done + PAIRS, "right")))
            size = (last - first)[low:high]
            who = np.repeat(np.arange(low, high), size)
            other = order[np.arange(len(who)) - np.repeat(np.cumsum(size) - size, size) + np.repeat(first[low:high], size)]
            a, b = (other, who) if flipped else (who, other)
            yield a, b, np.minimum(end_a[a], end_b[b]) - np.maximum(start_a[a], start_b[b]) + 1
            low = high


def shared_cells(mine: DataFrame, theirs: DataFrame, key: str, other: str) -> DataFrame:
    """(tile, key, other, cells): how many cells the spans of two tables share, by their keys."""
    kinds = dict(mine.dtypes) | {other: dict(theirs.dtypes)[other]}
    banded = lambda df, k: stored(df.select("tile", F.floor(F.col("row") / BAND_ROWS).alias("band"), F.col("row").cast("long").alias("row"), F.col("low").cast("long").alias("low"), F.col("high").cast("long").alias("high"), F.col(k).alias("__key")), "spans")
    a, b = banded(mine, key), banded(theirs, other)
    a, b, by = split_crowded(a, b, ["tile", "band"], BLOCK_SPANS)
    b, a, by = split_crowded(b, a, by, BLOCK_SPANS)

    def joined(here: pa.Table, there: pa.Table) -> pa.Table:
        parts = [pa.table({key: here.column("__key").slice(0, 0), other: there.column("__key").slice(0, 0), "cells": pa.array([], pa.int64())})]
        arrays = [t.column(n).to_numpy() for t in (here, there) for n in ("row", "low", "high")]
        for x, y, n in overlaps(*arrays):
            pairs = pa.table({key: here.column("__key").take(pa.array(x)), other: there.column("__key").take(pa.array(y)), "cells": n})
            done = pairs.group_by([key, other]).aggregate([("cells", "sum")])
            parts.append(done.rename_columns({"cells_sum": "cells"}).select([key, other, "cells"]))
        table = pa.concat_tables(parts)
        tile = (here if here.num_rows else there).column("tile")[0].as_py()
        return table.append_column("tile", pa.array([tile] * table.num_rows, here.schema.field("tile").type)).select(["tile", key, other, "cells"])

    schema = f"tile {kinds['tile']}, `{key}` {kinds[key]}, `{other}` {kinds[other]}, cells long"
    return a.groupBy(*by).cogroup(b.groupBy(*by)).applyInArrow(joined, schema).groupBy("tile", key, other).agg(F.sum("cells").alias("cells"))
