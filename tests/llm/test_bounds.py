"""Time and memory that stay in proportion, whatever a text or a table holds."""

from __future__ import annotations

import random
import re
import resource
import time
import tracemalloc

import numpy as np
import pytest

from terrasheaf.llm import alignment, chat, decontam, kneser_ney, packing, pii, tokens, toxicity

PATTERNS = {f"{m.__name__.rsplit('.', 1)[1]}.{n}": p for m in (pii, chat, tokens, alignment) for n, p in vars(m).items() if isinstance(p, re.Pattern)}
#: Patterns that are tried at given places only.
ANCHORED = {"pii.DOMAIN", "pii.DOT_SIGN", "pii.SPELLED_SIGN"}
PREFIXES = ["", "x", "x -at", "a@b", "x at ", "system", "# system", "user", "1", "+", "plus ", "one two", "[", "[at", "(dot", "a.", "a -dot", "&#", "&commat", "?", "-", "1.", "```", "<|", "https://", "jane@mail dot"]
RUNS = [" ", "-", "\n", "#", "1", "a", ".", " -", "\t", "a-", "1 ", "_", "at ", "-at", " dot", "one ", "(", "[", "?", "\n#", "\r", "+1", "a."]


@pytest.mark.parametrize("name", sorted(PATTERNS))
def test_patterns_take_time_in_proportion(name):
    """A square of these lengths would take seconds."""
    pattern = PATTERNS[name]
    if isinstance(pattern.pattern, bytes):
        pattern = re.compile(pattern.pattern.decode("latin-1"), pattern.flags & ~re.LOCALE | re.ASCII)
    for prefix in PREFIXES:
        for run in RUNS:
            text = prefix + run * (15_000 // len(run)) + "x"
            began = time.process_time()
            if name in ANCHORED:
                assert pattern.fullmatch(text) is None or pattern.match(text)
            else:
                sum(1 for _ in pattern.finditer(text))
            took = time.process_time() - began
            assert took < 0.6, (prefix, run, took)


@pytest.mark.parametrize("text", ["x -at" + "-" * 1_000_000, "x at" + " " * 1_000_000 + "x", "\n" * 1_000_000 + "x", "system" + " " * 1_000_000, "#" * 1_000_000, "1 " * 500_000])
def test_a_megabyte_takes_seconds(text):
    began = time.process_time()
    pii.identifiers(text)
    chat.features(text)
    chat.cut(text)
    assert time.process_time() - began < 20


def test_listed_lines_are_found_as_before():
    for text, listed in (("a\n - b", 1), ("\n\n  1) x", 1), ("1.x", 0), ("a - b", 0), ("\t*\ty", 1), ("12. ", 1), (" - x", 1)):
        assert chat.features(text)[3] == listed
    for text, role in (("system  :", 1), ("SYSTEM prompt : hi", 1), ("system prompt", 0), ("## system", 1), ("# user: x", 2), ("a: b", 3), ("Me : x", 2)):
        assert chat.cut(text)[0][2] == role


def test_many_pieces_of_one_token_pack_in_little_memory():
    packer = packing.Packer(4096, 0)
    ids = np.array([2], np.uint16)
    tracemalloc.start()
    began = time.process_time()
    rows = [row for k in range(packer.target + 5) for row in packer.add(k, ids)] + list(packer.close())
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak < 400e6 and time.process_time() - began < 120
    assert sorted(r[0] for r in rows) == list(range(packer.target + 5))
    ends: dict[int, int] = {}
    for _, _, length, _, _, sequence, offset, _ in rows:
        assert offset == ends.get(sequence, 0)
        ends[sequence] = offset + length
    assert max(ends.values()) <= 4096 and len(ends) <= 66


def test_bundles_hold_each_piece_once():
    rnd = random.Random(1)
    packer = packing.Packer(4096, 0)
    packer.open = [(k, 0, np.zeros(rnd.choice([0, 1, 5, 40, 63, 64, 500]), np.uint16), 9) for k in range(2000)]
    items = packer.bundles()
    assert sorted(i for item in items for i in item) == list(range(2000))
    assert all(len(item) == 1 or sum(len(packer.open[i][2]) for i in item) <= 64 for item in items)


def test_a_huge_text_shuts_no_other_out_of_the_sample(spark):
    rows = [(k, "x" * 5000 if k == 7 else f"text {k}", "en") for k in range(60)]
    docs = spark.createDataFrame(rows + [(3, "text 3", "de"), (None, "n", "en"), (4, None, "en")], "doc_id long, text string, lang string")
    labels = spark.createDataFrame([(k, k % 2) for k in range(60)] + [(5, 0), (None, 1)], "doc_id long, toxic int")
    found = toxicity.training_rows(docs, labels, max_bytes=6400)
    ids = sorted(r["doc_id"] for r in found)
    import zlib

    assert ids == [k for k in range(60) if zlib.crc32(str(k).encode()) % 3 != 1 and k != 7]
    assert sum(len(r["text"]) for r in toxicity.training_rows(docs, labels, max_bytes=640)) <= 640


def test_more_shards_than_descriptors_give_the_same_scores(spark):
    rnd = random.Random(2)
    texts = [(k, " ".join(f"w{rnd.randint(0, 3000)}" for _ in range(60))) for k in range(120)]
    docs = spark.createDataFrame(texts, "doc_id long, text string")
    few, many = (kneser_ney.train(docs.select("text"), n) for n in (2, 150))
    words = np.array([kneser_ney.xxhash.xxh64_intdigest(w.encode()) for _, t in texts for w in t.split()], np.uint64)
    soft, hard = resource.getrlimit(resource.RLIMIT_NOFILE)
    import os

    resource.setrlimit(resource.RLIMIT_NOFILE, (max(map(int, os.listdir("/proc/self/fd"))) + 40, hard))
    try:
        a, b = (m.log10(words[:-1], words[1:]) for m in (few, many))
    finally:
        resource.setrlimit(resource.RLIMIT_NOFILE, (soft, hard))
    assert np.allclose(a[0], b[0], rtol=1e-12, atol=0) and np.array_equal(a[1], b[1])
    assert len(many.arrays) == 300


def test_many_blocks_of_windows_find_what_one_does(spark):
    rnd = random.Random(4)
    prose = lambda n: " ".join(rnd.choice("abcdefgh") + str(rnd.randint(0, 40)) for _ in range(n))
    items = [(k, prose(30)) for k in range(6)]
    docs = [(k, prose(40) + " " + " ".join(rnd.choice(items)[1].split()[5:25]) + " " + prose(20)) for k in range(30)] + [(99, None)]
    frames = spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string")
    one, many = (sorted(map(tuple, decontam.decontaminate(*frames, block_windows=n).collect())) for n in (10**6, 12))
    assert one == many and sum(r[-1] for r in one) == 30
