"""Token alignment against whole texts encoded by the two libraries, and the minimal perfect hash."""

from __future__ import annotations

import random
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pytest

from terrasheaf.llm import alignment
from terrasheaf.llm.common import SharedFiles

A, B = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model")


def whole(both, text):
    """(ids of A, ids of B, groups as lists) of a whole text, without the splitting into words."""
    if not text:
        return None
    a, b = both.a.encode(" " + text, add_special_tokens=False).ids, both.b.encode(text)
    bytes_a, bytes_b = [both.bytes_a[i] for i in a], [both.bytes_b[i] for i in b]
    if not b"".join(bytes_a) == b"".join(bytes_b) == (" " + text).encode():
        return None
    ends = lambda parts: np.cumsum([len(p) for p in parts]).tolist()
    ea, eb = ends(bytes_a), ends(bytes_b)
    out, i, j = [], 0, 0
    for cut in sorted(set(ea) & set(eb)):
        x, y = ea.index(cut) + 1, eb.index(cut) + 1
        out.append((a[i:x], b[j:y]))
        i, j = x, y
    return a, b, out


def brute(both, rows):
    found = [whole(both, t) for _, t in rows]
    counts = Counter((g[0][-1], g[1][-1]) for x in found if x for g in x[2])
    best = defaultdict(int)
    for (_, b), n in counts.items():
        best[b] = max(best[b], n)
    out = []
    for (i, _), x in zip(rows, found, strict=True):
        if x is None:
            out.append((i, 0, 0, 0, 0, 0, 0, ""))
            continue
        links = [(g[0][-1], g[1][-1]) for g in x[2]]
        text = ";".join(",".join(map(str, p)) + "|" + ",".join(map(str, q)) for p, q in x[2])
        out.append((i, len(x[0]), len(x[1]), len(x[2]), len(links), sum(counts[k] == best[k[1]] for k in links), sum(counts[k] for k in links), text))
    return out


ALPHABET = ["a", "the", "Étion", "x", " ", "  ", "\n", "\t ", "1", "23", "!", "'s", "ﬁ", "é", "　", "\xa0", "▁", "<|endoftext|>", "<s>", "\x00", "\x1c ", "\x85 ", "中文", "🙂", "\r\n", " .", "  ", "<0x0A>", "don't", "aaaaaaa", "​"]


def texts(rnd, n):
    return ["".join(rnd.choice(ALPHABET) for _ in range(rnd.randint(0, 14))) for _ in range(n)]


def test_words_give_what_whole_texts_give():
    both = alignment.aligner(A, B)
    assert both.splits
    rnd = random.Random(1)
    for text in texts(rnd, 4000) + [" ", "a ", " a", "a  b ", "\n a", "▁"]:
        if not text:
            continue
        lists = list(both.words(text))
        assert sum(lists, []) and "".join(" " + w for w in sum(lists, [])) == " " + text
        words = sum(lists, [])
        found = both.align(words)
        want = whole(both, text)
        assert (want is None) == (len(found.order) < len(words)), repr(text)
        if want:
            at = np.cumsum([0, *found.sizes_a]), np.cumsum([0, *found.sizes_b])
            ids = [found.spread([x[i:j] for i, j in zip(c, c[1:])]) for x, c in zip((found.a.tolist(), found.b.tolist()), at)]
            assert sum(ids[0], []) == want[0] and sum(ids[1], []) == want[1], repr(text)
            assert ";".join(found.spread(found.texts())) == ";".join(",".join(map(str, a)) + "|" + ",".join(map(str, b)) for a, b in want[2]), repr(text)


def test_rows_as_by_brute_force(spark):
    rnd = random.Random(2)
    rows = [(i if i % 7 else None, t) for i, t in enumerate(texts(rnd, 150))] + [(5, None), (6, ""), (9, "▁ one"), (9, "one two"), (9, "one two")]
    docs = spark.createDataFrame([(i, t, 1, "g") for i, t in rows], "doc_id long, text string, n_a int, groups string").repartition(40)
    order = lambda r: (r[0] is None, r[0] or 0, *r[1:])
    got = sorted(map(tuple, alignment.align_tokens(docs, A, B).collect()), key=order)
    assert got == sorted(brute(alignment.aligner(A, B), rows), key=order)
    assert alignment.align_tokens(docs.limit(0), A, B).collect() == []


def test_long_texts_are_split_in_parts(spark):
    rnd = random.Random(3)
    words = ["".join(rnd.choice("abcdé1.") for _ in range(rnd.randint(1, 7))) for _ in range(400)]
    long = " ".join(rnd.choice(words) for _ in range(500_000))
    rows = [(1, long), (2, long[: 1 << 20] + " ▁"), (3, "z" * 30_000 + " a"), (4, long + " ▁ " + long[:50])]
    got = {r["doc_id"]: r for r in alignment.align_tokens(spark.createDataFrame(rows, "doc_id long, text string"), A, B).collect()}
    both = alignment.aligner(A, B)
    a = both.a.encode(" " + long, add_special_tokens=False).ids
    assert (got[1]["n_a"], got[1]["n_b"]) == (len(a), len(both.b.encode(long)))
    assert got[1]["groups"].count(";") + 1 == got[1]["n_groups"] and got[1]["groups"].startswith(f"{a[0]}")
    assert got[2]["n_a"] == got[4]["n_a"] == 0 and got[2]["groups"] == "" and got[3]["n_a"] > 0


@pytest.mark.parametrize("n", [0, 1, 2, 1000, 200_000])
def test_minimal_perfect_hash(tmp_path, n):
    rnd = np.random.default_rng(n)
    keys = np.unique(rnd.integers(0, 1 << 31, n).astype(np.uint64))
    files = SharedFiles(f"file://{tmp_path}")
    alignment.MinimalHash.of(keys).write(files, "h")
    table = alignment.MinimalHash.read(files, "h")
    assert np.array_equal(np.sort(table.verified(keys)), np.arange(len(keys)))
    others = np.setdiff1d(rnd.integers(0, 1 << 31, 1000).astype(np.uint64), keys)
    assert (table.verified(others) == -1).all()


def test_units_give_what_whole_texts_give():
    both = alignment.aligner(A, B)
    assert both.cuts
    rnd = random.Random(4)
    more = [*ALPHABET, "don't", "'re", "é'", "a", "a.", "a1", "z.\nThe", "\n", "&&&", "a.b.c", "_", "²", "́", "\x7f", "ʰ", "×", ".\r"]
    for _ in range(4000):
        text = "".join(rnd.choice(more) for _ in range(rnd.randint(1, 14)))
        units, want = sum(both.words(text, units=True), []), whole(both, text)
        found = both.align(units, units=True)
        assert (want is None) == (len(found.order) < len(units)), repr(text)
        if want:
            assert (found.sizes_a.sum(), found.sizes_b.sum()) == (len(want[0]), len(want[1])), repr(text)
            assert ";".join(found.spread(found.texts())) == ";".join(",".join(map(str, a)) + "|" + ",".join(map(str, b)) for a, b in want[2]), repr(text)


def test_what_follows_a_word_does_not_make_it_new():
    both = alignment.aligner(A, B)
    words = ["qu" + x + y for x in "bcdfghjklm" for y in "aeiouäöüßé"]
    docs = [" ".join(w + end for w in words).encode() for end in ("", ".", ",", ").", "&&&", "***", "$$$", ".\nThe", "'", "!", "?")]
    made = []
    memo = alignment.Memo(lambda new: made.extend(new) or [b""] * len(new))
    for doc in docs:
        for group in alignment.sliced(both, [doc]):
            memo.add(set().union(*group))
    assert len(made) == len(set(made)) <= len(words) + len(docs)


def test_other_files_are_not_cut_where_letters_end(spark, tmp_path):
    import io

    import sentencepiece
    from tokenizers import Tokenizer

    rows = [(1, "ab. abab. ab, ba."), (2, "ab.ab b. b"), (3, None), (4, "ab.\nab")]
    added = Tokenizer.from_file(A)
    added.add_tokens(["b."])
    added.save(str(tmp_path / "a.json"))
    model = io.BytesIO()
    sentencepiece.SentencePieceTrainer.train(
        sentence_iterator=iter(["ab. ab. abab. ba. ab,"] * 50), model_writer=model, model_type="bpe", vocab_size=272, byte_fallback=True,
        split_by_unicode_script=False, normalization_rule_name="identity", remove_extra_whitespaces=False, hard_vocab_limit=False, minloglevel=2,
    )
    (tmp_path / "b.model").write_bytes(model.getvalue())
    for a, b in ((str(tmp_path / "a.json"), B), (A, str(tmp_path / "b.model"))):
        both = alignment.aligner(a, b)
        assert not both.cuts
        assert sorted(map(tuple, alignment.align_tokens(spark.createDataFrame(rows, "doc_id long, text string"), a, b).collect())) == brute(both, rows)
