"""Quality rules on whole texts: counts per document, and repetition found by a suffix array over its words."""

from __future__ import annotations

from array import array
from collections import defaultdict
from collections.abc import Iterator
from itertools import chain, count

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from terrasheaf.llm.common import kept_and_text, runs, texts_of, with_columns

#: A repeated substring counts from this many words on.
MIN_REPEAT_WORDS = 10
#: A document is rejected if repeated substrings cover a larger share of its words, or if one of them is longer than either limit.
MAX_COVERED = 0.3
MAX_REPEAT_SHARE = 0.2
MAX_REPEAT_WORDS = 100

SPACES = b" \t\n\r\x0b\x0c"
CONTINUATION = bytes(range(0x80, 0xC0))
SYMBOLS = b"#*$%&|<>"
OTHER_BYTES = bytes(b for b in range(256) if b not in SYMBOLS)


def suffix_array(ids: np.ndarray, doc: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """The suffixes of some documents, each up to its document's end: document by document, in order.

    ``ids`` are the words of the documents in a row, ``doc`` each word's document and ``ends`` the end of that document. Sorted by prefix
    doubling in place; only suffixes that still share a prefix with another take part in the next round."""
    n = len(ids)
    key = doc * np.int64(ids.max(initial=0) + 1) + ids
    order = np.argsort(key, kind="stable")
    sorted_key = key[order]
    first = np.ones(n, bool)
    first[1:] = sorted_key[1:] != sorted_key[:-1]
    rank = np.empty(n, np.int64)
    rank[order] = np.maximum.accumulate(np.where(first, np.arange(n), 0))
    width = 1
    slots = np.flatnonzero(~(first & np.append(first[1:], True)))
    while len(slots):
        at = order[slots]
        beyond = at + width
        follow = np.where(beyond < ends[at], rank[np.minimum(beyond, n - 1)] + 1, 0)
        head = rank[at]
        resort = np.lexsort((follow, head))
        at, follow, head = at[resort], follow[resort], head[resort]
        order[slots] = at
        fresh = np.ones(len(at), bool)
        fresh[1:] = (head[1:] != head[:-1]) | (follow[1:] != follow[:-1])
        rank[at] = np.maximum.accumulate(np.where(fresh, slots, -1))
        slots = slots[~(fresh & np.append(fresh[1:], True))]
        width *= 2
    return order


def numbers(values: array) -> np.ndarray:
    return np.frombuffer(values, np.int64) if len(values) else np.zeros(0, np.int64)


def common_prefixes(ids: np.ndarray, ends: np.ndarray, order: np.ndarray, least: int) -> np.ndarray:
    """For each slot k of the suffix array, how many words the suffixes at k - 1 and k have in common (none if of different documents).

    Up to ``least`` words, neighbours are compared word by word for all slots at once. Kasai's pass extends the others in the order of the
    text: what a suffix shares with its neighbour is at most one word less than what the suffix before it shares with its own."""
    n = len(order)
    lcp = np.zeros(n, np.int64)
    slots, a, b = np.arange(1, n), order[:-1], order[1:]
    mine = ends[a] == ends[b]
    slots, a, b = slots[mine], a[mine], b[mine]
    for step in range(least):
        i, j = a + step, b + step
        same = (i < ends[a]) & (j < ends[b]) & (ids[np.minimum(i, n - 1)] == ids[np.minimum(j, n - 1)])
        slots, a, b = slots[same], a[same], b[same]
        lcp[slots] += 1
    by_text = np.argsort(b, kind="stable")
    slots, a, b = slots[by_text], a[by_text], b[by_text]
    word, found, before, shared = array("q", ids.astype(np.int64).tobytes() if len(b) else b""), array("q"), -2, 0
    for i, j, end in zip(map(int, b), map(int, a), map(int, ends[b]), strict=True):
        shared = max(least, shared - 1) if i == before + 1 else least
        top = end - max(i, j)
        while shared < top and word[i + shared] == word[j + shared]:
            shared += 1
        found.append(shared)
        before = i
    lcp[slots] = numbers(found)
    return lcp


def lcp_intervals(lcp: np.ndarray, least: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """The intervals of the suffix array whose suffixes share ``least`` words or more, by a stack: first slot, last slot and words shared of
    each, the number of the interval that encloses it (-1 for none), and for every slot the smallest interval that it lies in (-1 for none).

    Each interval is a repeated substring that can't be extended to the right; enclosing ones have larger numbers."""
    first, last, shared, parent = array("q"), array("q"), array("q"), array("q")
    within, number_of = array("q"), array("q")  # the interval of each slot in order of opening, and that one's number
    stack: list[list] = []  # words shared, first slot, place in order of opening, numbers of enclosed intervals

    def close(at: int, value: int) -> tuple[int, int | None]:
        low, held = at, None
        while stack and stack[-1][0] > value:
            top = stack.pop()
            number_of[top[2]] = number = len(first)
            first.append(top[1])
            last.append(at)
            shared.append(top[0])
            parent.append(-1)
            for kid in top[3]:
                parent[kid] = number
            low = top[1]
            if stack and stack[-1][0] >= value:
                stack[-1][3].append(number)
            else:
                held = number
        return low, held

    slots, before = np.flatnonzero(lcp >= least), -1
    for k, value in zip(map(int, slots), map(int, lcp[slots]), strict=True):
        if k != before + 1 and stack:
            close(before, 0)
        low, held = close(k - 1, value)
        if not stack or stack[-1][0] < value:
            stack.append([value, low, len(number_of), [] if held is None else [held]])
            number_of.append(-1)
        within.append(stack[-1][2])
        before = k
    close(before, 0)
    smallest = np.full(len(lcp) + 1, -1, np.int64)
    depth = np.zeros(len(lcp) + 1, np.int64)
    own = numbers(number_of)[numbers(within)]
    for shift in (0, 1):  # a shared prefix of slots k - 1 and k concerns both
        better = lcp[slots] > depth[slots - shift]
        smallest[slots[better] - shift], depth[slots[better] - shift] = own[better], lcp[slots[better]]
    return numbers(first), numbers(last), numbers(shared), numbers(parent), smallest[:-1]


def maximal(ids: np.ndarray, ends: np.ndarray, order: np.ndarray, first: np.ndarray, last: np.ndarray) -> np.ndarray:
    """Which intervals are maximal repeated substrings: they can't be extended to the left either, as not all are preceded by one word."""
    starts = np.concatenate([[True], ends[1:] != ends[:-1]])
    ahead = np.where(starts, -1 - np.arange(len(ids)), np.roll(ids, 1))[order]
    changes = np.cumsum(np.concatenate([[False], ahead[1:] != ahead[:-1]]))
    return changes[last] > changes[first]


def repeats(ids: np.ndarray, doc: np.ndarray, ends: np.ndarray, least: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The suffix array, the words each slot shares with the one before (exact from ``least`` on), and for each slot the length of the
    longest maximal repeated substring of ``least`` words or more that starts there, 0 for none.

    The spans of these cover all that maximal repeats cover: a repeat that can be extended to the left lies in one that can't."""
    order = suffix_array(ids, doc, ends)
    lcp = common_prefixes(ids, ends, order, least)
    first, last, shared, parent, smallest = lcp_intervals(lcp, least)
    longest = np.where(maximal(ids, ends, order, first, last), shared, 0).tolist() if len(first) else []
    for k in range(len(longest) - 1, -1, -1):
        if not longest[k] and parent[k] >= 0:
            longest[k] = longest[parent[k]]
    return order, lcp, np.array([*longest, 0], np.int64)[smallest]


def covered(starts: np.ndarray, lengths: np.ndarray, n: int) -> np.ndarray:
    """Marks the positions in the union of spans."""
    edge = np.zeros(n + 1, np.int64)
    np.add.at(edge, starts, 1)
    np.add.at(edge, starts + lengths, -1)
    return np.cumsum(edge[:-1]) > 0


def measures(texts: list[bytes]) -> dict[str, np.ndarray]:
    """The measures of some texts: word and character counts, and how far maximal repeated substrings cover each and the longest of them."""
    words = [t.split() for t in texts]
    n_words = np.array([len(w) for w in words], np.int64)
    number: dict[bytes, int] = defaultdict(count().__next__)
    ids = np.fromiter(map(number.__getitem__, chain.from_iterable(words)), np.int64, int(n_words.sum()))
    doc = np.repeat(np.arange(len(texts)), n_words)
    bounds = np.cumsum(n_words)
    order, lcp, longest = repeats(ids, doc, np.repeat(bounds, n_words), MIN_REPEAT_WORDS)

    def per_doc(mark: np.ndarray) -> np.ndarray:
        return np.bincount(doc[mark], minlength=len(texts)).astype(np.int64)

    trio = np.flatnonzero(lcp >= 3)
    trio = np.unique(np.concatenate([order[trio], order[trio - 1]]))
    long = np.flatnonzero(longest)
    peak = np.zeros(len(texts), np.int64)
    np.maximum.at(peak, doc[order[long]], longest[long])
    dup_lines = np.zeros(len(texts), np.int64)
    for k, text in enumerate(texts):
        lines = [x for x in text.split(b"\n") if x.strip(SPACES)]
        dup_lines[k] = len(lines) - len(set(lines))
    return {
        "n_words": n_words,
        "word_chars": np.array([len(t.translate(None, SPACES + CONTINUATION)) for t in texts], np.int64),
        "n_symbols": np.array([len(t.translate(None, OTHER_BYTES)) for t in texts], np.int64),
        "n_dup_lines": dup_lines,
        "n_repeat_words": per_doc(covered(trio, np.full(len(trio), 3), len(ids))),
        "n_covered_words": per_doc(covered(order[long], longest[long], len(ids))),
        "longest_repeat": peak,
    }


COLUMNS = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_covered_words", "longest_repeat"]


def text_measures(docs: DataFrame, keep: list[str], text_col: str = "text") -> DataFrame:
    """The columns ``keep`` of ``docs`` (but those with the name of a measure) and the measures of each whole text; one pass without a shuffle."""
    rows, keep, name = kept_and_text(docs, keep, text_col, COLUMNS)
    kept = docs.select(*keep).schema
    ddl = ", ".join([f"`{f.name}` {f.dataType.simpleString()}" for f in kept.fields] + [f"{c} long" for c in COLUMNS])

    def measured(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = texts_of(batch, name)
            schema = pa.schema([batch.schema.field(c) for c in keep] + [(c, pa.int64()) for c in COLUMNS])
            for start, end in runs(texts):
                yield with_columns(batch, keep, schema, start, end, **measures(texts[start:end]))

    return rows.mapInArrow(measured, ddl)


def verdict(measured: DataFrame) -> DataFrame:
    """Adds base_failed (under 50 words, or over half of them in repeated three-word windows) and kept."""
    failed = (F.col("n_words") < 50) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))
    share = F.col("n_covered_words") / F.greatest(F.col("n_words"), F.lit(1))
    long = (F.col("longest_repeat") > MAX_REPEAT_WORDS) | (F.col("longest_repeat") > MAX_REPEAT_SHARE * F.col("n_words"))
    return measured.withColumn("base_failed", failed).withColumn("kept", ~F.col("base_failed") & (share <= MAX_COVERED) & ~long)


def quality_rules(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The measures and the verdict of every whole text.

    Null or empty text has no words and fails the base rules; a null id stays; each row gives one row, repeated or not; no rows give no
    rows; other columns are ignored.
    """
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    return verdict(text_measures(rows, ["doc_id"]))
