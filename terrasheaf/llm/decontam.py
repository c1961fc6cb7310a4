"""Benchmark decontamination: a prefix-filtered join of item windows with whole documents, verified word by word."""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from terrasheaf.llm.common import Memo, hash_memo, kept_and_text, materialize, paired, runs, texts_of, with_columns, word_hashes

#: Words of a window, and of a shingle (shorter windows have shingles of their own length).
WINDOW_WORDS = 10
SHINGLE_WORDS = 3
#: Windows that are broadcast at once, some tens of MB; a larger benchmark is worked off in blocks of as many.
BLOCK_WINDOWS = 200_000
#: Blocks that are searched for in one stage.
STAGE_BLOCKS = 4

#: Lower-cases A-Z and turns every byte that is not part of a word into a space.
FOLD = bytes(b + 32 if 65 <= b <= 90 else b if 48 <= b <= 57 or 97 <= b <= 122 or b >= 128 else 32 for b in range(256))

WINDOW_SCHEMA = "item_id long, window array<binary>"


def words_of(text: bytes) -> list[bytes]:
    return text.translate(FOLD).split()


def item_windows(benchmark: DataFrame, width: int = WINDOW_WORDS, id_col: str = "item_id", text_col: str = "text") -> DataFrame:
    """(item_id, window): every ``width`` consecutive words of each item, or all words of a shorter one; wordless items have none."""
    schema = pa.schema([("item_id", pa.int64()), ("window", pa.list_(pa.binary()))])

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            items, found = [], []
            for item, text in zip(batch.column(0).to_pylist(), texts_of(batch, "text"), strict=True):
                words = words_of(text)
                if words and item is not None:
                    mine = {tuple(words[i : i + width]) for i in range(max(1, len(words) - width + 1))}
                    found += sorted(mine)
                    items += [item] * len(mine)
            yield pa.RecordBatch.from_arrays([pa.array(items, pa.int64()), pa.array(found, pa.list_(pa.binary()))], schema=schema)

    rows = benchmark.select(F.col(id_col).cast("long").alias("item_id"), F.col(text_col).cast("string").alias("text"))
    return rows.mapInArrow(cut, WINDOW_SCHEMA)


def shingles(hashes: np.ndarray, width: int) -> np.ndarray:
    """A hash of every ``width`` consecutive words."""
    out = hashes[: len(hashes) - width + 1]
    for k in range(1, width):
        out = paired(out, hashes[k : len(hashes) - width + 1 + k])
    return out


class Sieve:
    """A sorted set of 64-bit tokens, behind a bitmap by their low bits that turns most others away."""

    def __init__(self, tokens: np.ndarray):
        self.tokens = np.unique(tokens)
        self.bits = max(16, math.ceil(math.log2(max(1, len(self.tokens)))) + 6)
        self.bitmap = np.zeros(1 << self.bits, bool)
        self.low = np.uint64((1 << self.bits) - 1)
        self.bitmap[(self.tokens & self.low).astype(np.int64)] = True

    def find(self, values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Positions of ``values`` that are in the set, and their places there."""
        at = np.flatnonzero(self.bitmap[(values & self.low).astype(np.int64)])
        if not len(at) or not len(self.tokens):
            return at[:0], at[:0]
        place = np.minimum(np.searchsorted(self.tokens, values[at]), len(self.tokens) - 1)
        hit = self.tokens[place] == values[at]
        return at[hit], place[hit]


class Block:
    """Some windows with their shingles; ``choose`` takes the rarest shingle of each as its prefix token."""

    def __init__(self, windows: list[tuple[bytes, ...]], items: list[list[int]]):
        memo = hash_memo()
        self.windows, self.items = windows, items
        self.shingles = [shingles(h, min(SHINGLE_WORDS, len(h))) for h in (word_hashes(memo, list(w)) for w in windows)]
        self.widths = sorted({min(SHINGLE_WORDS, len(w)) for w in windows})

    def sieves(self) -> dict[int, Sieve]:
        return {k: Sieve(np.concatenate([s for s, w in zip(self.shingles, self.windows, strict=True) if min(SHINGLE_WORDS, len(w)) == k])) for k in self.widths}

    def choose(self, frequency: dict[int, int]) -> None:
        """To hold a whole window a document has to hold all its shingles, so one of them, the rarest, is prefix enough."""
        self.prefixes: dict[int, Sieve] = {}
        self.places: dict[int, list[list[tuple[int, int]]]] = {}
        chosen: dict[int, dict[int, list[tuple[int, int]]]] = {k: {} for k in self.widths}
        for n, (tokens, window) in enumerate(zip(self.shingles, self.windows, strict=True)):
            rarity = [(frequency.get(t, 0), t, i) for i, t in enumerate(tokens.tolist())]
            _, token, offset = min(rarity)
            chosen[min(SHINGLE_WORDS, len(window))].setdefault(token, []).append((n, offset))
        for k, by_token in chosen.items():
            self.prefixes[k] = Sieve(np.array(list(by_token), np.uint64))
            self.places[k] = [by_token[t] for t in self.prefixes[k].tokens.tolist()]
        del self.shingles

    def hits(self, words: list[bytes], low: int, high: int, found: dict[int, tuple[np.ndarray, np.ndarray]]) -> tuple[list[tuple[int, int]], set[int]]:
        """Verified occurrences (start, end) in the document of ``words[low:high]``, and the items whose windows occur."""
        spans: set[tuple[int, int]] = set()
        items: set[int] = set()
        for k, (at, place) in found.items():
            for p, t in zip(at.tolist(), place.tolist(), strict=True):
                for n, offset in self.places[k][t]:
                    window = self.windows[n]
                    start = p - offset
                    # positional and length bounds, then the words themselves
                    if start >= low and start + len(window) <= high and tuple(words[start : start + len(window)]) == window:
                        spans.add((start - low, start - low + len(window)))
                        items.update(self.items[n])
        return sorted(spans), items


def document_shingles(memo: Memo, texts: list[bytes], sieves: dict[int, Sieve]) -> tuple[list[bytes], np.ndarray, dict[int, tuple[np.ndarray, np.ndarray]]]:
    """The words of some texts in a row, where each text ends, and per shingle width the positions and places of shingles in the sieve.

    Shingles that straddle two texts may be among them; what uses them checks the bounds."""
    words: list[bytes] = []
    ends = np.zeros(len(texts), np.int64)
    for k, text in enumerate(texts):
        words += words_of(text)
        ends[k] = len(words)
    memo.trim()
    hashes = word_hashes(memo, words)
    return words, ends, {k: s.find(shingles(hashes, k)) for k, s in sieves.items() if len(words) >= k}


def shingle_frequency(texts: DataFrame, sieves) -> DataFrame:
    """(token, n): how often each shingle of a (broadcast) block occurs in all texts (the only column), summed per task first."""
    schema = pa.schema([("token", pa.int64()), ("n", pa.int64())])

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        given = sieves.value
        totals = {k: np.zeros(len(s.tokens), np.int64) for k, s in given.items()}
        memo = hash_memo()
        for batch in batches:
            texts = texts_of(batch, batch.schema.names[0])
            for start, end in runs(texts):
                for k, (_, place) in document_shingles(memo, texts[start:end], given)[2].items():
                    totals[k] += np.bincount(place, minlength=len(totals[k]))
        for k, total in totals.items():
            some = np.flatnonzero(total)
            yield pa.RecordBatch.from_arrays([pa.array(given[k].tokens[some].view(np.int64)), pa.array(total[some])], schema=schema)

    return texts.mapInArrow(count, "token long, n long").groupBy("token").agg(F.sum("n").alias("n"))


def sha256_of(items: set[int]) -> str:
    return hashlib.sha256(",".join(sorted(map(str, items))).encode()).hexdigest()


def contamination(docs: DataFrame, benchmark: DataFrame, keep: list[str], text_col: str = "text", width: int = WINDOW_WORDS, block_windows: int = BLOCK_WINDOWS) -> DataFrame:
    """The columns ``keep`` of ``docs`` (but those with the name of a result) with n_words, n_hit, n_items, items_sha256 and contaminated; see
    ``decontaminate``."""
    spark = docs.sparkSession
    windows = item_windows(benchmark, width).groupBy("window").agg(F.sort_array(F.collect_set("item_id")).alias("items"))
    windows = materialize(windows.withColumn("digest", F.xxhash64("window")), "windows")
    blocks = max(1, -(-windows.count() // block_windows))
    texts, keep, name = kept_and_text(docs, keep, text_col, ["n_words", "n_hit", "n_items", "items_sha256", "contaminated", "__hits", "__items"])
    kept = docs.select(*keep).schema
    carried = texts.select("*", F.lit(None).cast("array<long>").alias("__hits"), F.lit(None).cast("array<long>").alias("__items"))
    ddl = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in carried.schema.fields)
    final = ", ".join([f"`{f.name}` {f.dataType.simpleString()}" for f in kept.fields] + ["n_words long, n_hit long, n_items long, items_sha256 string, contaminated boolean"])
    for k in range(blocks):
        rows = windows.where(F.pmod("digest", F.lit(blocks)) == k).collect()  # about block_windows rows
        block = Block([tuple(map(bytes, r["window"])) for r in rows], [r["items"] for r in rows])
        counts = shingle_frequency(texts.select(name), spark.sparkContext.broadcast(block.sieves())).collect()  # one row for a shingle of the block
        block.choose({r["token"] & (2**64 - 1): r["n"] for r in counts})
        sent, last = spark.sparkContext.broadcast(block), k == blocks - 1

        def match(batches: Iterator[pa.RecordBatch], sent=sent, last=last) -> Iterator[pa.RecordBatch]:
            block, memo = sent.value, hash_memo()
            for batch in batches:
                texts = texts_of(batch, name)
                before = batch.column(batch.schema.get_field_index("__hits"))
                items_before = batch.column(batch.schema.get_field_index("__items"))
                for start, end in runs(texts):
                    words, ends, found = document_shingles(memo, texts[start:end], block.prefixes)
                    split = {n: (at, place, np.searchsorted(at, np.concatenate([[0], ends]))) for n, (at, place) in found.items()}
                    all_spans, all_items, low = [], [], 0
                    for i, high in enumerate(ends.tolist()):
                        mine = {n: (at[c[i] : c[i + 1]], place[c[i] : c[i + 1]]) for n, (at, place, c) in split.items() if c[i] < c[i + 1]}
                        spans, items = block.hits(words, low, high, mine) if mine else ([], set())
                        flat = before[start + i].as_py() or []
                        all_spans.append(flat + [x for span in spans for x in span])
                        all_items.append(set(items_before[start + i].as_py() or ()) | items)
                        low = high
                    if last:
                        n_words = np.diff(np.concatenate([[0], ends]))
                        hit = [covered_words(s) for s in all_spans]
                        schema = pa.schema([batch.schema.field(batch.schema.get_field_index(c)) for c in keep] + [("n_words", pa.int64()), ("n_hit", pa.int64()), ("n_items", pa.int64()), ("items_sha256", pa.string()), ("contaminated", pa.bool_())])
                        yield with_columns(batch, keep, schema, start, end, n_words=n_words, n_hit=hit, n_items=[len(s) for s in all_items], items_sha256=[sha256_of(s) for s in all_items], contaminated=[h > 0 for h in hit])
                    else:
                        yield with_columns(batch, [c for c in batch.schema.names if c not in ("__hits", "__items")], batch.schema, start, end, __hits=all_spans, __items=[sorted(s) for s in all_items])

        carried = carried.mapInArrow(match, final if last else ddl)
        if not last and k % STAGE_BLOCKS == STAGE_BLOCKS - 1:
            carried = materialize(carried, "searched")
    return carried


def covered_words(flat: list[int]) -> int:
    """The number of words in the union of spans, given as start, end, start, end and so on."""
    total, reach = 0, 0
    for start, end in sorted(zip(flat[::2], flat[1::2], strict=True)):
        total += max(0, end - max(start, reach))
        reach = max(reach, end)
    return total


def decontaminate(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text", width: int = WINDOW_WORDS, block_windows: int = BLOCK_WINDOWS) -> DataFrame:
    """Per document: doc_id, n_words, n_hit (words inside any occurrence of an item's window), n_items (items with a window that occurs),
    items_sha256 and contaminated.

    Windows are distinct word sequences, each with all its items. Shingles are ordered by how rare they are in all documents, and each
    window joins on its rarest. Only windows are broadcast, ``block_windows`` at most at a time; documents are read twice for each block
    and never shuffled. ``STAGE_BLOCKS`` blocks are searched for in one stage, each by a Python worker of its own; then what was found is
    stored with the documents. Null or empty text has no words; items without words or with a null id never occur; repeated documents stay and
    repeated items count once; an empty benchmark finds nothing; other columns are ignored.
    """
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    items = benchmark.select(F.col("item_id").cast("long").alias("item_id"), F.col("text").cast("string").alias("text"))
    return contamination(rows, items, ["doc_id"], "text", width, block_windows)
