"""Interpolated modified Kneser-Ney bigram model: counted in Spark, stored as sorted hash arrays, memory-mapped by workers."""

from __future__ import annotations

import mmap
import uuid
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.fs as pafs
import xxhash
from pyspark import SparkFiles
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from terrasheaf.llm.common import hash_memo, mixed, paired, runs, scratch_path, segments, texts_of, with_columns, word_hashes

#: Hashes of what stands before the first word of a text and of its end token; no word holds a space.
BEGIN = np.uint64(xxhash.xxh64_intdigest(b" begin"))
END = np.uint64(xxhash.xxh64_intdigest(b" end"))
#: Bigrams that a task holds before it sends their counts on, and tokens that are scored at a time.
FLUSH = 3_000_000
SCORE_TOKENS = 1_000_000
#: Bytes of training text for each shard of the model; a task holds what one shard's bigrams are in all blocks.
SHARD_BYTES = 16 << 20
#: Files that a worker keeps mapped.
MAPS = 8_000

BLOCK_SCHEMA = "shard int, kind string, a binary, b binary, c binary"
#: Columns of the words' table beside its sorted hashes: occurrences, followers' occurrences, distinct followers seen once, twice and
#: three times or more, and distinct words before it.
WORD_COLUMNS = [("count", "<u8"), ("followed", "<u8"), ("n1", "<u4"), ("n2", "<u4"), ("n3", "<u4"), ("before", "<u4")]


def planes(x: np.ndarray) -> bytes:
    """Sorted numbers as differences, their bytes transposed, which the shuffle's compression makes small."""
    return np.diff(x, prepend=np.uint64(0)).view(np.uint8).reshape(-1, 8).T.tobytes()


def unplaned(data: bytes) -> np.ndarray:
    return np.cumsum(np.ascontiguousarray(np.frombuffer(data, np.uint8).reshape(8, -1).T).view(np.uint64).ravel(), dtype=np.uint64)


def packed_counts(x: np.ndarray) -> bytes:
    """Counts as a byte each; 255 and more follow in full, in order."""
    large = x >= 255
    return np.where(large, 255, x).astype(np.uint8).tobytes() + x[large].astype("<u8").tobytes()


def unpacked_counts(data: bytes, n: int) -> np.ndarray:
    out = np.frombuffer(data, np.uint8, n).astype(np.uint64)
    out[out == 255] = np.frombuffer(data, "<u8", offset=n)
    return out


def group_starts(keys: np.ndarray) -> np.ndarray:
    """Where each distinct value of sorted keys begins."""
    return np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]])) if len(keys) else np.zeros(0, np.int64)


def tally(keys: np.ndarray, *values: np.ndarray) -> tuple[np.ndarray, ...]:
    """The distinct keys in order and the sums of values for each."""
    order = np.argsort(keys)
    keys = keys[order]
    starts = group_starts(keys)
    return keys[starts], *(np.add.reduceat(v[order], starts) if len(keys) else v for v in values)


def shard_bounds(keys: np.ndarray, shards: int) -> np.ndarray:
    """Where each of ``shards`` equal ranges of hashes begins and ends in sorted ``keys``."""
    edges = [(i << 64) // shards for i in range(1, shards)]
    return np.concatenate([[0], np.searchsorted(keys, np.array(edges, np.uint64)), [len(keys)]]).astype(np.int64)


class Folder:
    """Files of several arrays in the shared folder, by any address that Arrow's file systems know. Where all machines mount the folder, files
    are mapped where they are; else Spark brings each file to each executor once (``send``), and its workers map that copy."""

    def __init__(self, uri: str):
        self.uri = uri
        self.fs, self.path = pafs.FileSystem.from_uri(uri)
        self.mounted = isinstance(self.fs, pafs.LocalFileSystem)

    def name(self, file: str) -> str:
        return f"{self.path.rsplit('/', 1)[-1]}-{file}"

    def write(self, file: str, arrays: list[np.ndarray]) -> None:
        """Whole or not at all, so a task that runs twice does no harm. The lengths come first; every array begins at a multiple of 8 bytes."""
        draft = f"{self.path}/.{file}-{uuid.uuid4().hex}"
        self.fs.create_dir(self.path, recursive=True)
        with self.fs.open_output_stream(draft) as out:
            out.write(np.array([a.nbytes for a in arrays], "<u8").tobytes())
            for a in arrays:
                out.write(a.tobytes() + bytes(-a.nbytes % 8))
        self.fs.move(draft, f"{self.path}/{self.name(file)}")

    def send(self, spark: SparkSession, files: list[str]) -> None:
        if not self.mounted:
            for file in files:
                spark.sparkContext.addFile(f"{self.uri}/{self.name(file)}")

    def mapped(self, file: str, kinds: list[str]) -> list[np.ndarray]:
        path = f"{self.path}/{self.name(file)}" if self.mounted else SparkFiles.get(self.name(file))
        with open(path, "rb") as f:
            data = mmap.mmap(f.fileno(), 0, access=mmap.ACCESS_READ, trackfd=False)  # a map that holds no descriptor
        sizes, at, out = np.frombuffer(data, "<u8", len(kinds)).tolist(), 8 * len(kinds), []
        for kind, size in zip(kinds, sizes, strict=True):
            out.append(np.frombuffer(data, kind, size // np.dtype(kind).itemsize, at))
            at += size + -size % 8
        return out


def blocks(rows: list[tuple]) -> pa.RecordBatch:
    columns = list(zip(*rows, strict=True)) if rows else [[]] * 5
    types = [pa.int32(), pa.string(), pa.binary(), pa.binary(), pa.binary()]
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types, strict=True)], names=["shard", "kind", "a", "b", "c"])


def bigram_blocks(first_parts: list[np.ndarray], second_parts: list[np.ndarray], shards: int) -> pa.RecordBatch:
    """A block for each shard of the bigrams' hashes: distinct bigrams in order of their first word, with counts. Empties the lists it is given,
    so that their arrays are not held beside those made of them."""
    firsts, seconds = np.concatenate(first_parts), np.concatenate(second_parts)
    first_parts.clear()
    second_parts.clear()
    keys = paired(firsts, seconds)
    order = np.argsort(keys)
    keys = keys[order]
    starts = group_starts(keys)
    counts = np.diff(np.append(starts, len(keys))).astype(np.uint64)
    order = order[starts]
    firsts, seconds, bounds = firsts[order], seconds[order], shard_bounds(keys[starts], shards)
    del keys, order, starts
    rows = []
    for shard in range(shards):
        part = slice(bounds[shard], bounds[shard + 1])
        a, b, c = firsts[part], seconds[part], counts[part]
        if len(a):
            by_first = np.argsort(a)
            rows.append((shard, "bigrams", planes(a[by_first]), b[by_first].tobytes(), packed_counts(c[by_first])))
    return blocks(rows)


def count_bigrams(texts: DataFrame, shards: int) -> DataFrame:
    """Blocks of bigram counts of ``texts`` (column text), one for each task and shard at least."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        memo = hash_memo()
        firsts: list[np.ndarray] = []
        seconds: list[np.ndarray] = []
        held = 0
        for batch in batches:
            for text in texts_of(batch, "text"):
                last = np.array([BEGIN], np.uint64)
                for part in chain(segments(text.lower()), [None]):
                    words = np.array([END], np.uint64) if part is None else word_hashes(memo, part.split())
                    both = np.concatenate([last, words])
                    firsts.append(both[:-1])
                    seconds.append(both[1:])
                    last = both[-1:]
                    held += len(words)
                    if held >= FLUSH:
                        yield bigram_blocks(firsts, seconds, shards)
                        held = 0
                        memo.trim()
            memo.trim()
        if held:
            yield bigram_blocks(firsts, seconds, shards)

    return texts.mapInArrow(count, BLOCK_SCHEMA)


def histogram(x: np.ndarray) -> np.ndarray:
    """How many of ``x`` are 1, 2, 3 and 4."""
    return np.bincount(np.minimum(x, 5).astype(np.int64), minlength=6)[1:5].astype(np.int64)


class KneserNey:
    """The counted model, as workers use it: D, the totals, and the mapped arrays."""

    def __init__(self, uri: str, shards: int, tokens: int, types: int, texts: int, pairs: np.ndarray, befores: np.ndarray, bigram_types: int):
        self.uri, self.shards, self.tokens, self.types, self.texts, self.bigram_types = uri, shards, tokens, types, texts, bigram_types
        self.d2, self.d1 = self.discounts(pairs), self.discounts(befores)
        n1, n2, n3, n4 = befores.tolist()
        self.spread = (self.d1[1] * n1 + self.d1[2] * n2 + self.d1[3] * (types - n1 - n2)) / max(1, bigram_types)
        self.arrays = None

    @staticmethod
    def discounts(n: np.ndarray) -> np.ndarray:
        """D for counts 0, 1, 2 and 3 or more, from how many n-grams occur once to four times; where too few do, what they subtract is kept
        between 0 and the count."""
        n1, n2, n3, n4 = (float(x) for x in n)
        if not (n1 and n2):
            return np.array([0, 0.5, 0.75, 1.0])
        y = n1 / (n1 + 2 * n2)
        d = [0, 1 - 2 * y * n2 / n1, 2 - 3 * y * n3 / n2, 3 - 4 * y * n4 / n3 if n3 else 1.0]
        return np.array([0, *(min(max(x, 0.05), k - 0.05) for k, x in enumerate(d[1:], 1))])

    def __getstate__(self):
        return self.__dict__ | {"arrays": None}

    def mapped(self, kind: str, shard: int) -> list[np.ndarray]:
        """A shard's arrays, mapped when they are first asked for; pages that a task reads are the only ones in memory. Maps are dropped beyond
        ``MAPS``, since a process may have some ten thousands."""
        if self.arrays is None or len(self.arrays) >= MAPS:
            self.arrays = {}
        if (kind, shard) not in self.arrays:
            kinds = ["<u8", "u1", "<u8"] if kind == "bigrams" else ["<u8", *(k for _, k in WORD_COLUMNS)]
            self.arrays[kind, shard] = Folder(self.uri).mapped(f"{kind}-{shard}", kinds)
        return self.arrays[kind, shard]

    def bigram_counts(self, keys: np.ndarray) -> np.ndarray:
        """Counts of sorted bigram hashes."""
        out = np.zeros(len(keys), np.int64)
        bounds = shard_bounds(keys, self.shards)
        for shard in np.flatnonzero(np.diff(bounds)).tolist():
            asked = keys[bounds[shard] : bounds[shard + 1]]
            known, small, large = self.mapped("bigrams", shard)
            large = large.reshape(-1, 2)
            if len(known):
                at = np.minimum(np.searchsorted(known, asked), len(known) - 1)
                found = np.where(known[at] == asked, small[at], 0).astype(np.int64)
                if len(large) and (over := np.flatnonzero(found == 255)).size:
                    found[over] = large[np.searchsorted(large[:, 0], at[over].astype(np.uint64)), 1]
                out[bounds[shard] : bounds[shard + 1]] = found
        return out

    def word_table(self, keys: np.ndarray) -> dict[str, np.ndarray]:
        """The words' columns for sorted distinct hashes; zeros for unknown words."""
        out = {name: np.zeros(len(keys), np.float64) for name, _ in WORD_COLUMNS}
        bounds = shard_bounds(keys, self.shards)
        for shard in np.flatnonzero(np.diff(bounds)).tolist():
            asked = keys[bounds[shard] : bounds[shard + 1]]
            known, *columns = self.mapped("words", shard)
            if len(known):
                at = np.minimum(np.searchsorted(known, asked), len(known) - 1)
                hit = known[at] == asked
                for (name, _), column in zip(WORD_COLUMNS, columns, strict=True):
                    out[name][bounds[shard] : bounds[shard + 1]] = np.where(hit, column[at], 0)
        return out

    def log10(self, firsts: np.ndarray, seconds: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """For tokens ``seconds`` after ``firsts``: log10 of the model's probability, and the token's own training count."""
        words, place = np.unique(np.concatenate([firsts, seconds]), return_inverse=True)
        table = self.word_table(words)
        keys = paired(firsts, seconds)
        order = np.argsort(keys)
        counts = np.empty(len(keys), np.int64)
        counts[order] = self.bigram_counts(keys[order])
        before, followed = table["before"], table["followed"]
        low = (np.maximum(before - self.d1[np.minimum(before, 3).astype(np.int64)], 0)) / max(1, self.bigram_types) + (self.spread if self.bigram_types else 1.0) / (self.types + 1)
        weight = np.where(followed > 0, (self.d2[1] * table["n1"] + self.d2[2] * table["n2"] + self.d2[3] * table["n3"]) / np.maximum(followed, 1), 1.0)
        a, b = place[: len(firsts)], place[len(firsts) :]
        own = np.maximum(counts - self.d2[np.minimum(counts, 3)], 0) / np.maximum(followed[a], 1)
        return np.log10(own + weight[a] * low[b]), table["count"][b]


def train(texts: DataFrame, shards: int | None = None) -> KneserNey:
    """Counts ``texts`` (column text) and stores the model in the shared folder.

    Bigrams are counted per task and summed by ranges of their hash, so that a frequent word's bigrams spread over all shards; what a shard
    knows of each word is then summed by ranges of the words' hashes. There is a shard for every ``SHARD_BYTES`` of text.
    """
    spark = texts.sparkSession
    size = 0 if shards else texts.agg(F.sum(F.octet_length("text").cast("long"))).first()[0] or 0
    shards = shards or 1 + size // SHARD_BYTES
    uri = scratch_path(spark, "kneser-ney")

    def bigram_shard(key: tuple[pa.Scalar, ...], group: pa.Table) -> pa.Table:
        shard, firsts, seconds, counts = key[0].as_py(), [], [], []
        for a, b, c in zip(*(group.column(n).to_pylist() for n in "abc"), strict=True):
            firsts.append(unplaned(a))
            seconds.append(np.frombuffer(b, np.uint64))
            counts.append(unpacked_counts(c, len(seconds[-1])))
        first, second, count = map(np.concatenate, (firsts, seconds, counts))
        del firsts, seconds, counts, group
        keys = paired(first, second)
        order = np.argsort(keys)
        keys = keys[order]
        starts = group_starts(keys)
        sums = np.add.reduceat(count[order], starts) if len(keys) else count
        order = order[starts]
        keys, first, second = keys[starts], first[order], second[order]
        del count, order, starts
        over = np.flatnonzero(sums >= 255)
        large = np.stack([over.astype(np.uint64), sums[over]], 1).astype("<u8")
        Folder(uri).write(f"bigrams-{shard}", [keys.astype("<u8"), np.minimum(sums, 255).astype(np.uint8), large])
        rows = []
        for kind, word, values in (("first", first, (sums, sums == 1, sums == 2, sums >= 3)), ("second", second, (sums, np.ones(len(sums))))):
            words, *totals = tally(word, *(v.astype(np.uint64) for v in values))
            bounds = shard_bounds(words, shards)
            for to in range(shards):
                part = slice(bounds[to], bounds[to + 1])
                if bounds[to] < bounds[to + 1]:
                    rows.append((to, kind, planes(words[part]), b"".join(len(p).to_bytes(8, "little") + p for p in (packed_counts(t[part]) for t in totals)), None))
        rows.append((shard, "stats", histogram(sums).tobytes(), np.array([len(keys)], np.int64).tobytes(), None))
        return pa.Table.from_batches([blocks(rows)])

    def totals_of(data: bytes, n: int) -> list[np.ndarray]:
        out, at = [], 0
        while at < len(data):
            size = int.from_bytes(data[at : at + 8], "little")
            out.append(unpacked_counts(data[at + 8 : at + 8 + size], n))
            at += 8 + size
        return out

    stats_schema = pa.schema([(n, pa.int64()) for n in ("tokens", "types", "texts", "bigrams", *(f"p{k}" for k in range(1, 5)), *(f"b{k}" for k in range(1, 5)))])

    def word_shard(key: tuple[pa.Scalar, ...], group: pa.Table) -> pa.Table:
        shard = key[0].as_py()
        out = dict.fromkeys(stats_schema.names, 0)
        parts: dict[str, list] = {"first": [], "second": []}
        for kind, a, b in zip(*(group.column(n).to_pylist() for n in ("kind", "a", "b")), strict=True):
            if kind == "stats":
                for k, x in enumerate(np.frombuffer(a, np.int64), 1):
                    out[f"p{k}"] += int(x)
                out["bigrams"] += int(np.frombuffer(b, np.int64)[0])
            else:
                words = unplaned(a)
                parts[kind].append((words, *totals_of(b, len(words))))
        sums = {}
        for kind, width in (("first", 5), ("second", 3)):
            columns = [np.concatenate(c) for c in zip(*parts[kind], strict=True)] if parts[kind] else [np.zeros(0, np.uint64)] * width
            sums[kind] = tally(*columns)
        words = np.union1d(sums["first"][0], sums["second"][0])
        table = {name: np.zeros(len(words), np.uint64) for name, _ in WORD_COLUMNS}
        for kind, names in (("first", ("followed", "n1", "n2", "n3")), ("second", ("count", "before"))):
            at = np.searchsorted(words, sums[kind][0])
            for name, values in zip(names, sums[kind][1:], strict=True):
                table[name][at] = values
        Folder(uri).write(f"words-{shard}", [words.astype("<u8"), *(table[name].astype(kind) for name, kind in WORD_COLUMNS)])
        out["tokens"], out["types"] = int(table["count"].sum()), int((table["count"] > 0).sum())
        out["texts"] = int(table["count"][words == END].sum())
        for k, x in enumerate(histogram(table["before"][table["before"] > 0]), 1):
            out[f"b{k}"] = int(x)
        return pa.Table.from_pylist([out], stats_schema)

    empty = spark.range(shards).selectExpr("cast(id as int) as shard", "'bigrams' as kind", "cast('' as binary) as a", "cast('' as binary) as b", "cast('' as binary) as c")
    counted = count_bigrams(texts, shards).unionByName(empty).groupBy("shard").applyInArrow(bigram_shard, BLOCK_SCHEMA)
    stats = counted.groupBy("shard").applyInArrow(word_shard, ", ".join(f"{n} long" for n in stats_schema.names))
    total = stats.agg(*(F.sum(n).alias(n) for n in stats_schema.names)).first().asDict()
    Folder(uri).send(spark, [f"{kind}-{shard}" for shard in range(shards) for kind in ("bigrams", "words")])
    pick = lambda x: np.array([total[f"{x}{k}"] for k in range(1, 5)], np.int64)
    return KneserNey(uri, shards, total["tokens"], total["types"], total["texts"], pick("p"), pick("b"), total["bigrams"])


_models: dict[str, KneserNey] = {}


def score(docs: DataFrame, model: KneserNey, held_out: Column, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Scores every whole text: tokens, known tokens, the add-one unigram score, the model's log10 probability and its perplexity."""
    sent = docs.sparkSession.sparkContext.broadcast(model)  # totals and an address; the arrays stay in their files
    names = [("doc_id", pa.int64()), ("held_out", pa.bool_()), ("n_tokens", pa.int64()), ("n_known", pa.int64()), ("train_tokens", pa.int64()), ("base_score", pa.float64()), ("score", pa.float64()), ("perplexity", pa.float64())]
    schema = pa.schema(names)

    def scored(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = _models.setdefault(sent.value.uri, sent.value)
        memo = hash_memo()

        def sums(firsts: list[np.ndarray], seconds: list[np.ndarray], sizes: list[int]) -> np.ndarray:
            log, count = model.log10(np.concatenate(firsts), np.concatenate(seconds))
            base = np.log10((count + 1) / (model.tokens + model.types + 1))
            starts = np.cumsum([0, *sizes[:-1]])
            return np.stack([np.add.reduceat(x, starts) for x in (base, log, (count > 0).astype(np.float64))])

        for batch in batches:
            texts = texts_of(batch, "text")
            memo.trim()
            for start, end in runs(texts, 8 * SCORE_TOKENS):
                total = np.zeros((3, end - start))
                sizes = np.zeros(end - start, np.int64)
                firsts, seconds, lengths, owner, held = [], [], [], [], 0
                for k in range(start, end):
                    last = np.array([BEGIN], np.uint64)
                    for words in chain((p.split() for p in segments(texts[k].lower())), [None]):
                        hashes = np.array([END], np.uint64) if words is None else word_hashes(memo, words)
                        if len(hashes):
                            both = np.concatenate([last, hashes])
                            firsts.append(both[:-1])
                            seconds.append(both[1:])
                            last = both[-1:]
                            lengths.append(len(hashes))
                            owner.append(k - start)
                            held += len(hashes)
                            sizes[k - start] += len(hashes)
                        if held >= SCORE_TOKENS:
                            np.add.at(total, (slice(None), owner), sums(firsts, seconds, lengths))
                            firsts, seconds, lengths, owner, held = [], [], [], [], 0
                            memo.trim()
                if held:
                    np.add.at(total, (slice(None), owner), sums(firsts, seconds, lengths))
                yield with_columns(batch, ["doc_id", "held_out"], schema, start, end, n_tokens=sizes, n_known=total[2].astype(np.int64), train_tokens=np.full(end - start, model.tokens), base_score=total[0], score=total[1], perplexity=10 ** np.minimum(-total[1] / sizes, 300))

    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), held_out.alias("held_out"), F.col(text_col).cast("string").alias("text"))
    return rows.mapInArrow(scored, "doc_id long, held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double, perplexity double")


def held_out_rows(id_col: str = "doc_id", parts: int = 7, part: int = 2) -> Column:
    return F.coalesce(F.crc32(F.col(id_col).cast("string").cast("binary")) % parts == part, F.lit(False))


def lm_scores(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", parts: int = 7, part: int = 2, shards: int | None = None) -> DataFrame:
    """Trains on the rows whose crc32 of the id is not ``part`` modulo ``parts`` and scores all rows.

    Words are lower-cased in A-Z and split at ASCII white space; a text ends with one end token. Probabilities: the bigram's count less its
    discount, plus the first word's backed-off mass times the second's continuation probability, which in turn gives its own mass to a
    uniform share of 1 / (V + 1). Null or empty text is its end token alone; a row with a null id is a training row; repeated rows count
    as often as they occur; without training rows each token has probability 1; no rows give no rows; other columns are ignored.
    """
    held = held_out_rows(id_col, parts, part)
    model = train(docs.where(~held).select(F.col(text_col).cast("string").alias("text")), shards)
    return score(docs, model, held, id_col, text_col)
