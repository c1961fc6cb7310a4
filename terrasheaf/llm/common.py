"""Shared helpers for text batches inside tasks."""

from __future__ import annotations

import os
import uuid
from collections.abc import Callable, Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.fs as pafs
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from terrasheaf.runtime import join_counted, scratch_path  # noqa: F401
from terrasheaf.runtime import stored as materialize  # noqa: F401

#: Bytes of text that a task turns into Python words at a time.
SLICE_BYTES = 1 << 20
#: Entries that a memo of words holds before it starts anew; only speed depends on it.
MEMO_WORDS = 400_000

def kept_and_text(docs: DataFrame, keep: list[str], text_col: str, own: Iterable[str]) -> tuple[DataFrame, list[str], str]:
    """The columns of ``keep`` whose names are not among ``own`` and the text as a string, which is sent once: (rows, kept columns, name of
    the text's column)."""
    keep = [c for c in keep if c not in own and c != "__text"]
    if text_col in keep and dict(docs.dtypes)[text_col] == "string":
        return docs.select(*keep), keep, text_col
    return docs.select(*keep, F.col(text_col).cast("string").alias("__text")), keep, "__text"


def texts_of(batch: pa.RecordBatch, name: str) -> list[bytes]:
    """The UTF-8 bytes of a string column; null is empty."""
    column = batch.column(batch.schema.get_field_index(name))
    return [b"" if x is None else x for x in column.cast(pa.large_binary() if pa.types.is_large_string(column.type) else pa.binary()).to_pylist()]


def runs(texts: list[bytes], limit: int = SLICE_BYTES) -> Iterator[tuple[int, int]]:
    """Ranges of neighbouring rows with about ``limit`` bytes of text each, one row at least."""
    start, size = 0, 0
    for i, text in enumerate(texts):
        size += len(text)
        if size >= limit:
            yield start, i + 1
            start, size = i + 1, 0
    if start < len(texts):
        yield start, len(texts)


def segments(text: bytes, limit: int = SLICE_BYTES) -> Iterator[bytes]:
    """A long text in parts that end before ASCII white space, so that no word is cut; a word longer than ``limit`` stays whole."""
    start = 0
    while len(text) - start > limit:
        end = start + limit
        while end < len(text) and text[end] not in b" \t\n\r\x0b\x0c":
            end += 1
        yield text[start:end]
        start = end
    yield text[start:]


class Memo(dict):
    """Values of words, computed at first sight. ``trim`` bounds it between batches."""

    def __init__(self, value: Callable):
        self.value = value

    def __missing__(self, key):
        self[key] = out = self.value(key)
        return out

    def trim(self, limit: int = MEMO_WORDS) -> None:
        if len(self) > limit:
            self.clear()


def hash_memo() -> Memo:
    return Memo(xxhash.xxh64_intdigest)


def word_hashes(memo: Memo, words: list[bytes]) -> np.ndarray:
    return np.fromiter(map(memo.__getitem__, words), np.uint64, len(words))


def mixed(x: np.ndarray) -> np.ndarray:
    """A bijection of 64 bits that spreads them."""
    x = x ^ (x >> np.uint64(33))
    x = x * np.uint64(0xFF51AFD7ED558CCD)
    x = x ^ (x >> np.uint64(33))
    x = x * np.uint64(0xC4CEB9FE1A85EC53)
    return x ^ (x >> np.uint64(33))


def paired(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """One hash for the pair (a, b), in that order."""
    return mixed(mixed(a) * np.uint64(0x9E3779B97F4A7C15) + b)


def parts_of(values: np.ndarray) -> Iterator[tuple[int, np.ndarray]]:
    """Each distinct number with its positions."""
    order = np.argsort(values, kind="stable")
    starts = np.flatnonzero(np.diff(values[order], prepend=-1)) if len(values) else []
    for low, high in zip(starts, [*starts[1:], len(order)], strict=False):
        yield int(values[order[low]]), order[low:high]


def with_columns(batch: pa.RecordBatch, names: list[str], schema: pa.Schema, start: int, end: int, **columns) -> pa.RecordBatch:
    """Rows ``start`` to ``end`` of ``batch``'s columns ``names``, with further columns."""
    part = batch.slice(start, end - start)
    arrays = [part.column(part.schema.get_field_index(n)) if n in names else pa.array(columns[n], schema.field(n).type) for n in schema.names]
    return pa.RecordBatch.from_arrays(arrays, schema=schema)


class SharedFiles:
    """Files of bytes in a folder that driver and executors share, by any address that Arrow's file systems know. Where the folder is mounted a
    file is mapped, so that only the pages that are asked for are read; elsewhere it is read whole, and ``CACHE_BYTES`` of files are kept."""

    CACHE_BYTES = 256 << 20

    def __init__(self, uri: str):
        self.uri, self._place, self._kept = uri, None, {}

    def __getstate__(self):
        return {"uri": self.uri, "_place": None, "_kept": {}}

    def place(self) -> tuple[pafs.FileSystem, str]:
        if self._place is None:
            self._place = pafs.FileSystem.from_uri(self.uri)
        return self._place

    def write(self, name: str, data: bytes) -> None:
        """Whole or not at all, so a task that runs twice does no harm."""
        fs, path = self.place()
        draft = f"{path}/.{name}-{uuid.uuid4().hex}"
        fs.create_dir(path, recursive=True)
        with fs.open_output_stream(draft) as out:
            out.write(data)
        fs.move(draft, f"{path}/{name}")

    def read(self, name: str) -> np.ndarray:
        """The bytes of a file."""
        fs, path = self.place()
        if name not in self._kept:
            while self._kept and sum(x.nbytes for x in self._kept.values() if not isinstance(x, np.memmap)) > self.CACHE_BYTES:
                self._kept.pop(next(iter(self._kept)))
            if isinstance(fs, pafs.LocalFileSystem):
                if len(self._kept) >= 512:  # a map may hold a file's descriptor
                    self._kept.clear()
                self._kept[name] = np.memmap(f"{path}/{name}", np.uint8, "r") if os.path.getsize(f"{path}/{name}") else np.zeros(0, np.uint8)
            else:
                with fs.open_input_file(f"{path}/{name}") as f:
                    self._kept[name] = np.frombuffer(f.readall(), np.uint8)
        return self._kept[name]
