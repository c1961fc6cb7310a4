"""Alignment of the tokens of two tokenizers, with corpus-wide counts of the id pairs that end together, held under a minimal perfect hash."""

from __future__ import annotations

import re
import sys
from collections import Counter
from collections.abc import Callable, Collection, Iterable, Iterator
from functools import cached_property
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from terrasheaf.llm.common import SharedFiles, materialize, mixed, parts_of, runs, scratch_path, texts_of, with_columns
from terrasheaf.llm.tokens import byte_characters, load_tokenizer

#: Ranges of the pairs' hashes. There are no more pairs than the product of both vocabularies, which bounds a range whatever the corpus.
RANGES = 64
#: Parts that are joined at a time on the way up the tree.
FAN = 32
#: Words that a Python worker keeps, and characters of the longest one it does; only speed depends on them.
KEPT_WORDS, KEPT_CHARS = 400_000, 80
#: Characters of a text that are split into words at a time, bytes of texts likewise, and distinct pairs that a task holds before it sends them.
PART_CHARS, SLICE_BYTES, FLUSH = 1 << 20, 4 << 20, 2_000_000

#: Words that are encoded in a row.
JOINED = 64

#: A space after something that isn't white space, where no token of either side goes across; other white space before a space.
BORDER = re.compile(r"(?<=\S)(?= )")
#: What ends a run of letters, of characters that all tables of Unicode class alike.
AFTER = frozenset(chr(c) for c in range(128) if chr(c) != " " and not chr(c).isalpha())
LATER = re.compile("[{0}](?<=[A-Za-zÀ-ÖØ-öø-ÿ][{0}])".format(re.escape("".join(sorted(AFTER)))))
ODD = [chr(c) + " " for c in range(sys.maxunicode + 1) if chr(c).isspace()]
BLOCK_SCHEMA = "range long, node long, keys binary, counts binary"


class Aligner:
    """Both tokenizers of a Python worker, and the alignment of words.

    A word is what stands between two borders, without its first space. The first tokenizer splits there before it merges, and the second
    has no piece with a space after another character, so a text's tokens are its words' tokens in a row and every border ends tokens of
    both. Files for which this does not hold (``splits``) get whole texts as single words.

    A unit is a word, cut again where letters end: there the first tokenizer's pattern splits, and no piece of the second goes on (``cuts``).
    The units of a word after its first have an "a" before them, which stands for the letters and is left out of what they give. There are
    far fewer different units than words."""

    def __init__(self, path_a: str, path_b: str):
        import sentencepiece
        from tokenizers.pre_tokenizers import ByteLevel

        self.a, self.b = load_tokenizer(path_a), sentencepiece.SentencePieceProcessor(model_file=path_b)
        self.a.encode_special_tokens = True
        shown = {c: b for b, c in byte_characters().items()}
        vocab = self.a.get_vocab(with_added_tokens=True)
        self.bytes_a = [b""] * (max(vocab.values()) + 1)
        for token, i in vocab.items():
            self.bytes_a[i] = bytes(map(shown.get, token)) if all(c in shown for c in token) else token.encode()
        pieces = [self.b.id_to_piece(i) for i in range(self.b.get_piece_size())]
        self.bytes_b = [bytes([int(p[3:5], 16)]) if self.b.is_byte(i) else p.replace("▁", " ").encode() for i, p in enumerate(pieces)]
        self.size_a, self.size_b = (np.array(list(map(len, x)), np.int64) for x in (self.bytes_a, self.bytes_b))
        self.space = self.b.piece_to_id("▁")
        before = self.a.pre_tokenizer.pre_tokenize_str(" a  b\n\n c1 d ")
        plain = self.a.normalizer is None and [s for s, _ in before] == ["Ġa", "Ġ", "Ġb", "ĊĊ", "Ġc", "1", "Ġd", "Ġ"]
        inside = any("▁" in p.lstrip("▁") for p in pieces)
        tried = ("ﬁ ", "é", "　  x", "①Å")
        same = all(b"".join(self.bytes_b[i] for i in self.b.encode(t)) == b" " + t.encode() for t in tried)
        self.splits = plain and same and not inside and bytes(self.bytes_b[self.space]) == b" "
        pre, added = self.a.pre_tokenizer, self.a.get_added_tokens_decoder().values()
        known = type(pre) is ByteLevel and pre.use_regex and not pre.add_prefix_space and all(t.special for t in added)
        whole = [p for i, p in enumerate(pieces) if not (self.b.is_byte(i) or self.b.is_control(i) or self.b.is_unknown(i))]
        self.cuts = self.splits and known and not any(map(LATER.search, whole))

    @cached_property
    def shown(self) -> dict[str, np.ndarray]:
        """All ids as text, before each separator."""
        return {end: np.array([f"{i}{end}" for i in range(max(len(self.bytes_a), len(self.bytes_b)))], object) for end in ",|;\n"}

    def words(self, text: str, units: bool = False) -> Iterator[list[str]]:
        """The words (or ``units``) of a text in lists, a part of it at a time."""
        text, start = " " + text, 0
        if not self.splits:
            yield [text[1:]]
            return
        while start < len(text):
            end = BORDER.search(text, start + PART_CHARS) if len(text) - start > PART_CHARS + 1 else None
            part = text[start : end.start()] if end else text[start:]
            start += len(part)
            if units and self.cuts:
                part = LATER.sub(r" a\g<0>", part)
            if "  " in part or any(x in part for x in ODD[:-1]):
                yield [w[1:] for w in BORDER.split(part)]
            else:
                yield part[1:].split(" ")

    def align(self, words: list[str], units: bool = False) -> Aligned:
        """Both tokenizers' ids of all words (or ``units``), and the groups that they make. Words that end in no white space are encoded ``JOINED`` at a time, in
        a row, as they would stand in a text."""
        plain = [k for k, w in enumerate(words) if self.splits and w and not w[-1].isspace() and "▁" not in w]
        taken = set(plain)
        odd = [k for k, w in enumerate(words) if k not in taken and not (self.splits and "▁" in w)]
        encode = getattr(self.a, "encode_batch_fast", self.a.encode_batch)

        def encoded(rows: list[str]) -> tuple[list[list[int]], list[list[int]]]:
            firsts = [e.ids for e in encode([" " + r for r in rows], add_special_tokens=False)]
            seconds = self.b.encode(rows, num_threads=1)
            return firsts, [b or [self.space] * (not r) for r, b in zip(rows, seconds, strict=True)] if self.splits else seconds

        rows = [" ".join(words[k] for k in plain[i : i + JOINED]) for i in range(0, len(plain), JOINED)] + [words[k] for k in odd]
        firsts, seconds = encoded(rows)
        size = sum(1 + len(r.encode()) for r in rows)
        if not self.splits or any(int(n[list(chain.from_iterable(x))].sum()) != size for n, x in ((self.size_a, firsts), (self.size_b, seconds))):
            plain, odd = [], plain + odd  # one by one, as some have tokens of other bytes
            firsts, seconds = encoded([words[k] for k in odd])
            true = [self.true(words[k], a, b) for k, a, b in zip(odd, firsts, seconds, strict=True)]
            odd, firsts, seconds = ([x for x, ok in zip(lists, true, strict=True) if ok] for lists in (odd, firsts, seconds))
        order = plain + odd
        cut = [w[:1] == "a" and w[1:2] in AFTER for w in map(words.__getitem__, order)] if units and self.cuts else [False] * len(order)
        return Aligned(self, words, order, firsts, seconds, cut)

    def true(self, text: str, a: list[int], b: list[int]) -> bool:
        return b"".join(map(self.bytes_a.__getitem__, a)) == b" " + text.encode() == b"".join(map(self.bytes_b.__getitem__, b))


class Aligned:
    """The tokens of words ``order`` in one row, cut into groups where tokens of both end. As a word's tokens have as many bytes on either side,
    the ends of all words' tokens can be compared at once. The words that are not in ``order`` have no tokens; those that are ``cut`` leave out
    the letter that they begin with and the space before it."""

    def __init__(self, both: Aligner, words: list[str], order: list[int], firsts: list[list[int]], seconds: list[list[int]], cut: list[bool]):
        self.both, self.count, self.order = both, len(words), order
        self.a, self.b = (np.fromiter(chain.from_iterable(x), np.int64, sum(map(len, x))) for x in (firsts, seconds))
        ends_a, ends_b = np.cumsum(both.size_a[self.a]), np.cumsum(both.size_b[self.b])
        at = np.searchsorted(ends_b, ends_a)
        self.last_a = np.flatnonzero(ends_b[at] == ends_a) if len(ends_b) else at
        self.last_b = at[self.last_a]
        # in each group the last tokens end together, and no others do
        self.pairs = (self.a[self.last_a] * len(both.bytes_b) + self.b[self.last_b]).astype(np.uint64)
        sizes = 1 + np.fromiter(map(len, map(str.encode, map(words.__getitem__, order))), np.int64, len(order))
        ends = np.cumsum(sizes)
        begins = ends - sizes + 2 * np.array(cut, np.int64)
        before = lambda all_ends: [np.searchsorted(all_ends, x, "right") for x in (begins, ends)]
        self.sizes_a, self.sizes_b = (high - low for low, high in map(before, (ends_a, ends_b)))
        #: Each word's groups, from and to.
        self.starts, self.stops = before(ends_a[self.last_a])

    def spread(self, values: Iterable) -> list:
        """Values of the words that have tokens, in the order of all words; None for the others."""
        out = [None] * self.count
        for k, value in zip(self.order, values, strict=True):
            out[k] = value
        return out

    def per_word(self, values: np.ndarray) -> np.ndarray:
        """Sums over each word's groups."""
        total = np.concatenate([[0], np.cumsum(values)])
        return total[self.stops] - total[self.starts]

    def texts(self) -> list[str]:
        """Each word's groups as text: all tokens in the order of the groups, each with what follows it, in one row with a line for each word."""
        groups, ends = np.arange(len(self.pairs)), self.last_b[self.stops - 1]
        of_a, of_b = (np.repeat(groups, np.diff(last, prepend=-1)) for last in (self.last_a, self.last_b))
        at_a = np.arange(len(of_a)) + np.concatenate([[0], self.last_b + 1])[of_a]
        at_b = np.arange(len(of_b)) + self.last_a[of_b] + 1
        shown, out = self.both.shown, np.empty(len(of_a) + len(of_b), object)
        out[at_a], out[at_b] = shown[","][self.a], shown[","][self.b]
        out[at_a[self.last_a]], out[at_b[self.last_b]] = shown["|"][self.a[self.last_a]], shown[";"][self.b[self.last_b]]
        out[at_b[ends]] = shown["\n"][self.b[ends]]
        inside = np.cumsum(np.bincount(self.starts, minlength=len(groups) + 1) - np.bincount(self.stops, minlength=len(groups) + 1))[:-1] > 0
        kept = np.empty(len(out), bool)
        kept[at_a], kept[at_b] = inside[of_a], inside[of_b]
        return "".join(out[kept].tolist()).split("\n")[:-1]


_aligners: dict[tuple[str, str], Aligner] = {}


def aligner(path_a: str, path_b: str) -> Aligner:
    if (path_a, path_b) not in _aligners:
        _aligners[path_a, path_b] = Aligner(path_a, path_b)
    return _aligners[path_a, path_b]


class Memo:
    """What is known of words. Values come from ``made`` (words -> values, None for words without tokens) for all new words of a slice at once."""

    def __init__(self, made: Callable[[list[str]], list]):
        self.made, self.known, self.bad, self.often, self.long = made, {}, set(), set(), []

    @staticmethod
    def of(name: tuple, made: Callable[[list[str]], list]) -> Memo:
        """This worker's memo of the given name, which later tasks of the same pass find; that of another pass goes."""
        if name not in _memos:
            _memos.clear()
            _memos[name] = Memo(made)
        return _memos[name]

    def add(self, found: Collection[str]) -> None:
        """Learns the distinct words of a slice. Of too many words those stay that came again in a later slice than their first."""
        if len(self.known) > KEPT_WORDS:
            kept = self.often if len(self.often) <= KEPT_WORDS // 2 else set()
            self.known = {w: self.known[w] for w in kept if w in self.known}
            self.bad.intersection_update(self.known)
            self.often = set()
        new = self.learn(found)
        self.often.update(found if not new else set(found).difference(new))

    def learn(self, words: Iterable[str]) -> list[str]:
        """Learns the words that are not known, and returns them."""
        new = [w for w in words if w not in self.known]
        values = self.made(new) if new else []
        self.known.update(zip(new, values, strict=True))
        self.long += [w for w in new if len(w) > KEPT_CHARS]
        if None in values:
            self.bad.update(w for w, value in zip(new, values, strict=True) if value is None)
        return new

    def drop_long(self) -> None:
        for w in self.long:
            self.known.pop(w, None)
            self.bad.discard(w)
        self.long = []


_memos: dict[tuple, Memo] = {}


def key_range(keys: np.ndarray) -> np.ndarray:
    return (mixed(keys) >> np.uint64(64 - RANGES.bit_length() + 1)).astype(np.int64)


def packed(x: np.ndarray) -> bytes:
    """Numbers with their bytes transposed, which the shuffle's compression makes small."""
    return x.astype("<u8").view(np.uint8).reshape(-1, 8).T.tobytes()


def unpacked(data: bytes) -> np.ndarray:
    return np.ascontiguousarray(np.frombuffer(data, np.uint8).reshape(8, -1).T).view("<u8").ravel()


def summed(keys: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct keys in order, and the sums of their counts."""
    order = np.argsort(keys, kind="stable")
    keys = keys[order]
    starts = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]])) if len(keys) else np.zeros(0, np.int64)
    return keys[starts], np.add.reduceat(counts[order], starts) if len(keys) else counts


class MinimalHash:
    """A minimal perfect hash of distinct numbers, with the numbers themselves in the order of their hashes, so that others are told apart.

    Level by level the numbers left are dealt to twice as many bits; those alone on a bit set it and stay, the others go to the next level.
    A number's hash is how many bits are set before its own, over all levels."""

    def __init__(self, sizes: np.ndarray, bits: np.ndarray, ranks: np.ndarray, keys: np.ndarray):
        self.sizes, self.bits, self.ranks, self.keys = sizes, bits, ranks, keys
        self.starts = np.concatenate([[0], np.cumsum(sizes >> 6)]).astype(np.int64)

    @staticmethod
    def place(keys: np.ndarray, level: int, size: int) -> np.ndarray:
        return (mixed(keys + np.uint64((level * 0x9E3779B97F4A7C15) & 0xFFFFFFFFFFFFFFFF)) % np.uint64(size)).astype(np.int64)

    @classmethod
    def of(cls, keys: np.ndarray) -> MinimalHash:
        sizes, words, left = [], [], keys
        while len(left):
            size = 64 * (1 + len(left) // 32)
            at = cls.place(left, len(sizes), size)
            alone = np.bincount(at, minlength=size)[at] == 1
            bits = np.zeros(size, bool)
            bits[at[alone]] = True
            sizes.append(size)
            words.append(np.packbits(bits, bitorder="little").view("<u8"))
            left = left[~alone]
        bits = np.concatenate(words) if words else np.zeros(0, np.uint64)
        counts = np.bitwise_count(bits).astype(np.int64)
        made = cls(np.array(sizes, np.int64), bits, np.cumsum(counts) - counts, np.zeros(len(keys), np.uint64))
        made.keys[made.at(keys)] = keys
        return made

    def at(self, keys: np.ndarray) -> np.ndarray:
        """The hash of each key; for numbers that are none of the keys -1 or any hash."""
        out, left = np.full(len(keys), -1, np.int64), np.arange(len(keys))
        for level, size in enumerate(self.sizes.tolist()):
            place = self.place(keys[left], level, size)
            word = self.starts[level] + (place >> 6)
            bits, shift = self.bits[word], (place & 63).astype(np.uint64)
            hit = (bits >> shift & np.uint64(1)).astype(bool)
            below = np.bitwise_count(bits & ((np.uint64(1) << shift) - np.uint64(1))).astype(np.int64)
            out[left[hit]] = (self.ranks[word] + below)[hit]
            left = left[~hit]
            if not len(left):
                break
        return out

    def verified(self, keys: np.ndarray) -> np.ndarray:
        """The hash of each key, or -1 where the number stored there is another."""
        at = self.at(keys)
        return np.where((at >= 0) & (self.keys[at] == keys) if len(self.keys) else np.zeros(len(keys), bool), at, -1)

    def write(self, files: SharedFiles, name: str) -> None:
        head = np.array([len(self.sizes), len(self.bits), len(self.keys)], "<i8")
        files.write(name, b"".join(x.astype("<u8").tobytes() for x in (head, self.sizes, self.bits, self.ranks, self.keys)))

    @classmethod
    def read(cls, files: SharedFiles, name: str) -> MinimalHash:
        data = files.read(name).view("<u8")
        levels, words, keys = data[:3].astype(np.int64).tolist()
        sizes, bits, ranks, known = np.split(data[3:], np.cumsum([levels, words, words]))
        return cls(sizes.astype(np.int64), bits, ranks.astype(np.int64), known[:keys])


class PairCounts:
    """The counts of all id pairs, in files of the shared folder."""

    def __init__(self, files: SharedFiles):
        self.files, self.tables, self.best = files, {}, None

    def __getstate__(self):
        return {"files": self.files, "tables": {}, "best": None}

    def look_up(self, pairs: np.ndarray, ids_b: int) -> tuple[np.ndarray, np.ndarray]:
        """Each pair's count, and whether no other pair of its second id has more."""
        if self.best is None:
            self.best = self.files.read("best").view("<u8")
        counts = np.zeros(len(pairs), np.uint64)
        for k, mine in parts_of(key_range(pairs)):
            if k not in self.tables:
                self.tables[k] = MinimalHash.read(self.files, f"hash-{k}"), self.files.read(f"counts-{k}").view("<u8")
            table, known = self.tables[k]
            at = table.verified(pairs[mine])
            counts[mine[at >= 0]] = known[at[at >= 0]]
        return counts, counts == self.best[(pairs % np.uint64(ids_b)).astype(np.int64)]


def folded(table: DataFrame, nodes: int, merge: Callable, schema: str) -> DataFrame:
    """Joins the parts of each range ``FAN`` at a time, until one is left."""
    while True:
        nodes = -(-nodes // FAN)
        table = table.withColumn("node", F.floor(F.col("node") / FAN)).groupBy("range", "node").applyInArrow(merge, schema)
        if nodes <= 1:
            return table
        table = materialize(table, "parts")


def count_pairs(texts: DataFrame, path_a: str, path_b: str) -> PairCounts:
    """The first pass over ``texts`` (column text): counts of the pairs that end together.

    Each task sends its distinct pairs with counts, a block for each range of hashes. The distinct pairs of a range are joined in a tree, then
    hashed; the blocks become dense vectors under that hash, which are summed in a tree too, so no task or driver sees more than ``FAN``
    vectors of one range."""
    spark = texts.sparkSession
    files = SharedFiles(scratch_path(spark, "pairs"))

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        both = aligner(path_a, path_b)

        def pairs(words: list[str]) -> list[bytes | None]:
            found = both.align(words, units=True)
            data = found.pairs.tobytes()
            return found.spread([data[i:j] for i, j in zip((found.starts * 8).tolist(), (found.stops * 8).tolist(), strict=True)])

        memo = Memo.of((files.uri, "pairs"), pairs)
        node, parts, held = TaskContext.get().partitionId(), [(np.zeros(0, np.uint64), np.zeros(0, np.uint64))], 0

        def blocks() -> pa.RecordBatch:
            keys, counts = parts[0]
            where = key_range(keys)
            mine = [(k, keys[at], counts[at]) for k, at in parts_of(where)]
            columns = [k for k, _, _ in mine], [node] * len(mine), [packed(x) for _, x, _ in mine], [packed(c) for _, _, c in mine]
            return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, (pa.int64(), pa.int64(), pa.binary(), pa.binary()), strict=True)], names=["range", "node", "keys", "counts"])

        for batch in batches:
            docs = texts_of(batch, "text")
            for start, end in runs(docs, SLICE_BYTES):
                short, *long = sliced(both, docs[start:end])
                seen = Counter(chain.from_iterable(short))
                memo.add(seen)
                if not memo.bad.isdisjoint(seen):
                    seen = Counter(chain.from_iterable(words for words in short if memo.bad.isdisjoint(words)))
                for group in long:  # the parts of a long text count if all of them are true
                    own, true = Counter(), True
                    for words in group:
                        memo.add(set(words))
                        true = true and memo.bad.isdisjoint(words)
                        own.update(words)
                    if true:
                        seen.update(own)
                if seen:
                    if long:
                        memo.learn(seen)
                    each = [memo.known[w] for w in seen]
                    sizes = np.fromiter(map(len, each), np.int64, len(each)) >> 3
                    parts.append(summed(np.frombuffer(b"".join(each), np.uint64), np.repeat(np.fromiter(seen.values(), np.uint64, len(seen)), sizes)))
                    held += len(parts[-1][0])
                    memo.drop_long()
                if held >= FLUSH:
                    parts = [summed(*map(np.concatenate, zip(*parts, strict=True)))]
                    held = 0
                    if len(parts[0][0]) >= FLUSH:
                        yield blocks()
                        parts = [(np.zeros(0, np.uint64), np.zeros(0, np.uint64))]
        parts = [summed(*map(np.concatenate, zip(*parts, strict=True)))]
        if len(parts[0][0]):
            yield blocks()

    nothing = spark.range(RANGES).selectExpr("id as range", "0L as node", "cast('' as binary) as keys", "cast('' as binary) as counts")
    sent = materialize(texts.mapInArrow(counted, BLOCK_SCHEMA).unionByName(nothing), "pair-blocks")
    nodes = 1 + sent.agg(F.max("node")).first()[0]
    names = ["range", "node", "keys", "counts"]

    def table_of(key: tuple[pa.Scalar, ...], keys: bytes, counts: bytes) -> pa.Table:
        return pa.table(dict(zip(names, ([key[0].as_py()], [key[1].as_py()], pa.array([keys], pa.binary()), pa.array([counts], pa.binary())), strict=True)))

    def united(key: tuple[pa.Scalar, ...], group: pa.Table) -> pa.Table:
        return table_of(key, packed(np.unique(np.concatenate([unpacked(k.as_py()) for k in group.column("keys")]))), b"")

    def hashed(key: tuple[pa.Scalar, ...], group: pa.Table) -> pa.Table:
        table = MinimalHash.of(unpacked(group.column("keys")[0].as_py()))
        table.write(files, f"hash-{key[0].as_py()}")
        return pa.table({"pairs": pa.array([len(table.keys)], pa.int64())})

    folded(sent.withColumn("counts", F.expr("cast('' as binary)")), nodes, united, BLOCK_SCHEMA).groupBy("range").applyInArrow(hashed, "pairs long").agg(F.sum("pairs")).first()

    def vector(key: tuple[pa.Scalar, ...], group: pa.Table) -> pa.Table:
        """The sum of blocks (with keys) and of vectors (without)."""
        table = MinimalHash.read(files, f"hash-{key[0].as_py()}")
        out = np.zeros(len(table.keys), np.uint64)
        for keys, counts in zip(group.column("keys"), group.column("counts"), strict=True):
            if keys.as_py():
                out[table.verified(unpacked(keys.as_py()))] += unpacked(counts.as_py())
            elif counts.as_py():
                out += unpacked(counts.as_py())
        return table_of(key, b"", packed(out))

    ids_b = aligner(path_a, path_b).b.get_piece_size()

    def stored(key: tuple[pa.Scalar, ...], group: pa.Table) -> pa.Table:
        counts = unpacked(group.column("counts")[0].as_py())
        files.write(f"counts-{key[0].as_py()}", counts.astype("<u8").tobytes())
        seconds = (MinimalHash.read(files, f"hash-{key[0].as_py()}").keys % np.uint64(ids_b)).astype(np.int64)
        best = np.zeros(ids_b, np.uint64)
        np.maximum.at(best, seconds, counts)
        there = np.flatnonzero(best)
        return pa.table({"b": pa.array(there, pa.int64()), "best": pa.array(best[there].astype(np.int64), pa.int64())})

    highest = folded(sent, nodes, vector, BLOCK_SCHEMA).groupBy("range").applyInArrow(stored, "b long, best long").groupBy("b").agg(F.max("best").alias("best"))
    best = np.zeros(ids_b, "<u8")
    for row in highest.collect():  # one row for each id of the second vocabulary at most
        best[row["b"]] = row["best"]
    files.write("best", best.tobytes())
    return PairCounts(files)


def sliced(both: Aligner, docs: list[bytes]) -> Iterator[list[list[str]] | Iterator[list[str]]]:
    """The units of texts: of all short ones in a list of lists, of each long one (over ``PART_CHARS`` bytes) as lists to come."""
    yield [words for t in docs if t and len(t) <= PART_CHARS for words in both.words(t.decode(), units=True)]
    for t in docs:
        if len(t) > PART_CHARS:
            yield both.words(t.decode(), units=True)


def align_tokens(docs: DataFrame, path_a: str, path_b: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per row: doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum and groups, as `a1,a2|b1;a3|b2,b3`.

    ``path_a`` is a byte-level file of the tokenizers library, ``path_b`` one of sentencepiece that puts a space before a text; the text is
    compared with a space before it. Offsets where tokens of both end cut them into groups; the last tokens of a group are linked. A pair's
    count is the number of its links in all rows, repeated rows included; n_best counts links whose pair no other pair of the same second id
    outnumbers, ties included. The first pass counts pairs (``count_pairs``); the second aligns the texts again and looks counts up.

    A null or empty text, or one whose tokens' bytes are not the text's (U+2581 in it, for instance), has no tokens: zeros and no groups, and
    counts nothing. Very long texts are split into words a part at a time; a null id stays; no rows give no rows; other columns are ignored."""
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    counts = count_pairs(rows.select("text"), path_a, path_b)
    numbers = ["n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum"]
    schema = pa.schema([(n, pa.int64()) for n in ["doc_id", *numbers]] + [("groups", pa.string())])

    def aligned(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        both = aligner(path_a, path_b)
        ids_b = both.b.get_piece_size()

        def known(words: list[str]) -> list[tuple | None]:
            found = both.align(words, units=True)
            sums, best = counts.look_up(found.pairs, ids_b)
            columns = (found.sizes_a, found.sizes_b, found.stops - found.starts, found.per_word(best), found.per_word(sums.astype(np.int64)))
            data = np.stack(columns, axis=1).astype(np.int64).tobytes()
            return found.spread(zip([data[i : i + 40] for i in range(0, len(data), 40)], found.texts(), strict=True))

        memo = Memo.of((counts.files.uri, "rows"), known)

        def row(parts: Iterator[list[str]]) -> tuple:
            """The sums over a text's words and its groups."""
            total, texts = np.zeros(5, np.int64), []
            for words in parts:
                if memo.bad and not memo.bad.isdisjoint(words):
                    return (0, 0, 0, 0, 0, 0, "")
                values = [memo.known[w] for w in words]
                total += np.frombuffer(b"".join([v[0] for v in values]), np.int64).reshape(-1, 5).sum(axis=0)
                texts.append(";".join([v[1] for v in values]))
            n_a, n_b, n, *rest = total.tolist()  # each group has one link
            return (n_a, n_b, n, n, *rest, ";".join(texts))

        def filled(parts: Iterator[list[str]]) -> Iterator[list[str]]:
            for words in parts:
                memo.add(set(words))
                yield words

        for batch in batches:
            docs = texts_of(batch, "text")
            for start, end in runs(docs, SLICE_BYTES):
                short, *long = sliced(both, docs[start:end])
                memo.add(set().union(*short))
                one = iter([row([words]) for words in short])
                many = iter([row(filled(parts)) for parts in long])
                memo.drop_long()
                out = [(next(one) if len(t) <= PART_CHARS else next(many)) if t else (0, 0, 0, 0, 0, 0, "") for t in docs[start:end]]
                yield with_columns(batch, ["doc_id"], schema, start, end, **dict(zip([*numbers, "groups"], zip(*out, strict=True), strict=True)))

    return rows.mapInArrow(aligned, ", ".join(f"{n} long" for n in ["doc_id", *numbers]) + ", groups string")
