"""Token counts of whole texts as a public tokenizer gives them, with huge documents encoded in overlapping chunks."""

from __future__ import annotations

import json
import os
import re
from array import array
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from terrasheaf.llm.common import Memo, runs, segments, texts_of, with_columns

#: Documents of more code points than this are encoded in chunks of as many.
CHUNK_CHARS = 32_768
OVERLAP_CHARS = 256
SPACES = " \t\n\r\x0b\x0c"


def load_tokenizer(path: str):
    os.environ["TOKENIZERS_PARALLELISM"] = "false"  # Spark's tasks are the parallelism
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(path)
    tokenizer.no_truncation()
    tokenizer.no_padding()
    return tokenizer


#: Texts of these characters only are lower-cased and split by the two lines below, as the tokenizer does it; others go through all of it.
PLAIN = re.compile("[\t-\r -~\u00c0-\u00d6\u00d8-\u00f6\u00f8-\u00ff]*")
PIECES = re.compile("[a-z\u00df-\u00f6\u00f8-\u00ff]+|[0-9]|'(?:s|t|re|ve|m|ll|d)|[^\\sa-z0-9\u00df-\u00f6\u00f8-\u00ff]+")
#: Pieces of words that a Python worker keeps; only speed depends on it.
KEPT = 400_000


def byte_characters() -> dict[int, str]:
    """The printable character that stands for each byte in the vocabulary: itself where it is printable, else the next from 256 on."""
    shown = [b for b in range(256) if 0x21 <= b <= 0x7E or 0xA1 <= b <= 0xAC or b >= 0xAE]
    rest = [b for b in range(256) if b not in set(shown)]
    return {b: chr(b) for b in shown} | {b: chr(256 + i) for i, b in enumerate(rest)}


# The normaliser and the splitting pattern of tokenizer files that texts may be split for as below.
NORMALIZERS = [{"type": "NFC"}, {"type": "Replace", "pattern": {"Regex": r"\s+"}, "content": " "}, {"type": "Lowercase"}]
SPLIT = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"


def splits_alike(path: str) -> bool:
    """Whether a tokenizer file normalises and splits texts in the way that ``WordIds`` relies on, and has no strings of its own but those
    between <| and |>."""
    with open(path, encoding="utf-8") as f:
        known = json.load(f)
    normal, split = known.get("normalizer") or {}, (known.get("pre_tokenizer") or {}).get("pretokenizers") or []
    alike = normal.get("normalizers") == NORMALIZERS and len(split) == 2 and split[0].get("pattern") == {"Regex": SPLIT} and split[0].get("invert") is True
    alike = alike and split[0].get("behavior") == "Removed" and split[1].get("type") == "ByteLevel" and not split[1].get("add_prefix_space") and not split[1].get("use_regex")
    plain = all(t["content"].startswith("<|") and " " not in t["content"] and not (t["normalized"] or t["lstrip"] or t["rstrip"]) for t in known.get("added_tokens", []))
    return alike and plain and known["model"]["type"] == "BPE" and not known.get("post_processor")


class WordIds:
    """Token ids of texts, from a memo of the ids of their pieces where the file's rules allow it (``splits_alike``), else from the library.

    The tokenizer splits lower-cased text into runs of letters, digits, contractions and other runs, and merges within each piece alone, so
    the ids of a text are its pieces' ids in a row. Where ASCII white space separates two words nothing carries over either: not
    composition (a space composes with nothing), not lower-casing (by code point), not the special strings (which hold no space).
    """

    def __init__(self, path: str):
        self.tokenizer, self.alike = load_tokenizer(path), splits_alike(path)
        if self.tokenizer.get_vocab_size() > 1 << 16:
            raise ValueError("ids of more than 16 bits are not supported")
        merge, shown = self.tokenizer.model.tokenize, byte_characters()
        self.pieces = Memo(lambda p: array("H", [t.id for t in merge(p if p.isascii() else "".join(map(shown.__getitem__, p.encode())))]).tobytes())
        self.words = Memo(lambda w: np.array(self.tokenizer.encode(w.decode(), add_special_tokens=False).ids, np.uint16).tobytes())

    def ids(self, text: bytes) -> np.ndarray:
        """All ids of a text, as 16-bit numbers; long texts a part at a time."""
        if not self.alike:
            return np.array(self.tokenizer.encode(text.decode(), add_special_tokens=False).ids, np.uint16)
        self.pieces.trim(KEPT)
        self.words.trim(KEPT)
        return np.frombuffer(b"".join(map(self.part, segments(text))), np.uint16)

    def part(self, text: bytes) -> bytes:
        if PLAIN.fullmatch(s := text.decode()) and "<|" not in s:
            return b"".join(map(self.pieces.__getitem__, PIECES.findall(s.lower())))
        return b"".join(map(self.words.__getitem__, text.split()))


_known: dict[str, WordIds] = {}


def word_ids(path: str) -> WordIds:
    """This Python worker's own; later tasks of the worker find what it has seen."""
    if path not in _known:
        _known[path] = WordIds(path)
    return _known[path]


def splice(text: str, low: int, high: int, left: list[tuple[int, int, int]], right: list[tuple[int, int, int]]) -> int | None:
    """A position in (low, high) from which the encodings of two overlapping chunks agree for sure, or None.

    ``left`` and ``right`` hold (start, end, id) of both chunks. A position is proven stable if ASCII white space stands before it, none
    stands at it, and the tokens of the word that starts there are the same in both, up to white space before ``high``.
    """
    mine: dict[int, int] = {s: k for k, (s, _, _) in reversed(list(enumerate(left))) if s >= low}
    theirs: dict[int, int] = {s: k for k, (s, _, _) in reversed(list(enumerate(right))) if s < high}
    for p in sorted(mine.keys() & theirs.keys()):
        if p <= low or text[p - 1] not in SPACES or text[p] in SPACES:
            continue
        end = p
        while end < high and text[end] not in SPACES:
            end += 1
        if end == high:
            return None
        i, j = mine[p], theirs[p]
        a = [t for t in left[i : i + end - p + 64] if t[0] < end]
        b = [t for t in right[j : j + end - p + 64] if t[0] < end]
        if a == b:
            return p
    return None


def count_in_chunks(tokenizer, text: str, chunk: int = CHUNK_CHARS, overlap: int = OVERLAP_CHARS) -> int:
    """The number of tokens of a huge text, encoded ``chunk`` code points at a time.

    Each chunk but the first starts ``overlap`` code points before the end of the one before; both are cut at a position that ``splice``
    proves stable. Where there is none the overlap doubles, and where it would reach back to the last cut, the chunk itself grows.
    """

    def encode(start: int, end: int) -> list[tuple[int, int, int]]:
        e = tokenizer.encode(text[start:end], add_special_tokens=False)
        return [(start + a, start + b, i) for (a, b), i in zip(e.offsets, e.ids, strict=True)]

    total, cut, end = 0, 0, min(len(text), chunk)
    left = encode(0, end)
    while end < len(text):
        width, size = overlap, chunk
        while True:
            start = end - width
            if start <= cut:
                end = min(len(text), end + size)
                size *= 2
                left = encode(cut, end)
                if end == len(text):
                    return total + len(left)
                width = overlap
                continue
            next_end = min(len(text), start + max(chunk, 2 * width))
            right = encode(start, next_end)
            at = splice(text, start, end, left, right)
            if at is not None:
                break
            width *= 2
        total += sum(s < at for s, _, _ in left)
        left, cut, end = [t for t in right if t[0] >= at], at, next_end
    return total + len(left)


def token_counts(docs: DataFrame, tokenizer_path: str, limit: int = 2048, id_col: str = "doc_id", text_col: str = "text", chunk: int = CHUNK_CHARS, overlap: int = OVERLAP_CHARS) -> DataFrame:
    """n_bytes, n_tokens and over_limit (more than ``limit`` tokens) of every whole text.

    One pass without a shuffle. Texts of more than ``chunk`` code points are encoded in overlapping chunks (``count_in_chunks``), others
    word by word; a tokenizer file with other rules of splitting than these rely on is left to the library, whole texts at a time. Null or empty text has 0 tokens; a null id stays; each row gives one row, repeated or not; other columns are ignored.
    """
    schema = pa.schema([("doc_id", pa.int64()), ("n_bytes", pa.int64()), ("n_tokens", pa.int64()), ("over_limit", pa.bool_())])

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = word_ids(tokenizer_path)
        for batch in batches:
            texts = texts_of(batch, "text")
            for start, end in runs(texts):
                part = texts[start:end]
                huge = {k: text for k, t in enumerate(part) if known.alike and len(t) > chunk and len(text := t.decode()) > chunk}
                counts = [len(ids) for ids in (known.ids(b"" if k in huge else t) for k, t in enumerate(part))]
                for k, text in huge.items():
                    counts[k] = count_in_chunks(known.tokenizer, text, chunk, overlap)
                yield with_columns(batch, ["doc_id"], schema, start, end, n_bytes=[len(t) for t in part], n_tokens=counts, over_limit=[c > limit for c in counts])

    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    return rows.mapInArrow(count, "doc_id long, n_bytes long, n_tokens long, over_limit boolean")
