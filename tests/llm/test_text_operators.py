"""Operators on texts against brute force, and their edge cases."""

from __future__ import annotations

import hashlib
import math
import random
import re
import time
import zlib
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pytest
import xxhash
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from terrasheaf import runtime
from terrasheaf.llm import chat, decontam, kneser_ney, packing, pii, repetition, secrets, simhash, tokens, toxicity
from terrasheaf.llm.common import join_counted
from terrasheaf.llm.components import components

TOKENIZER = public_tokenizers.path("word_bpe_49k.json")
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, words string, spans string, fp long, __text string"


def docs(spark, texts, ids=None, source=None):
    """Rows with columns that clash with names used inside the operators."""
    ids = list(range(len(texts))) if ids is None else ids
    rows = [(i, t, "en", source(k) if source else f"src{k % 3}", 0, "w", "s", 1, "x") for k, (i, t) in enumerate(zip(ids, texts, strict=True))]
    return spark.createDataFrame(rows, SCHEMA)


def lower(text):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text)


def words(text):
    return re.findall(r"[^\x20\x09-\x0D]+", text)


def prose(rnd, n, alphabet="abcdefgh"):
    return " ".join("".join(rnd.choice(alphabet) for _ in range(rnd.randint(1, 5))) for _ in range(n))


EDGES = [None, "", "   \n", "a", "A b", "x" * 5000, "é ü ñ " * 50, "same text here", "same text here", "\U0001f600 ok  end"]

OPERATORS = {
    "pii": lambda s, d: pii.find_personal_data(d),
    "lm": lambda s, d: kneser_ney.lm_scores(d, shards=3),
    "quality": lambda s, d: repetition.quality_rules(d),
    "pack": lambda s, d: packing.pack(d, TOKENIZER),
    "decontam": lambda s, d: decontam.decontaminate(d, s.createDataFrame([(1, "same text here"), (2, None), (None, "a b")], "item_id long, text string")),
    "toxicity": lambda s, d: toxicity.toxicity(d, s.createDataFrame([(0, 1), (1, 0), (2, None), (None, 1)], "doc_id long, toxic int")),
    "simhash": lambda s, d: simhash.near_duplicates(d),
    "tokens": lambda s, d: tokens.token_counts(d, TOKENIZER),
    "secrets": lambda s, d: secrets.find_secrets(d),
}


@pytest.mark.parametrize("name", OPERATORS)
def test_nulls_empty_long_and_repeated_rows(spark, name):
    d = docs(spark, EDGES, [0, 1, 2, 3, 4, 5, 6, 7, 7, None])
    rows = OPERATORS[name](spark, d).collect()
    per_id = Counter(r["doc_id"] for r in rows)
    if name == "pack":
        assert set(per_id) == {0, 1, 2, 3, 4, 5, 6, 7, None}
    else:
        assert per_id == Counter([0, 1, 2, 3, 4, 5, 6, 7, 7, None])
        same = [tuple(r) for r in rows if r["doc_id"] == 7]
        assert same[0] == same[1]


@pytest.mark.parametrize("name", OPERATORS)
def test_no_rows(spark, name):
    assert OPERATORS[name](spark, docs(spark, [])).collect() == []


PATTERNS = {"email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", "card": r"[0-9]([\x20-]?[0-9])+", "phone": r"\+[0-9][\x20().0-9-]+[0-9]"}


def base_pii(text):
    out = []
    for kind, pattern in PATTERNS.items():
        for m in re.finditer(pattern, text):
            digits = re.sub("[^0-9]", "", m[0])
            if kind == "ip" and any(int(x) > 255 for x in m[0].split(".")) or kind == "card" and not (14 <= len(digits) <= 19 and pii.luhn(digits)) or kind == "phone" and not 10 <= len(digits) <= 15:
                continue
            out.append((m.start(), m.end(), kind))
    return sorted(out, key=lambda s: (s[0], pii.KINDS.index(s[2])))


@settings(max_examples=400, deadline=None)
@given(st.lists(st.sampled_from(["a", "@", ".", "1", "25", "7", "+1", "-", " ", "(", ")", "é", "4111111111111111", "b-c", "\n", "256", "0", "٣"]), max_size=40))
def test_base_identifiers_equal_the_patterns(parts):
    text = "".join(parts)
    assert pii.all_spans(text)[0] == base_pii(text)


@pytest.mark.parametrize(
    ("text", "kind", "part"),
    [
        ("mail john.doe (at) example (dot) com now", "email", "john.doe (at) example (dot) com"),
        ("jane at mail dot example dot com", "email", "jane at mail dot example dot com"),
        ("see ｊｏｈｎ＠ｍａｉｌ．ｃｏｍ", "email", "ｊｏｈｎ＠ｍａｉｌ．ｃｏｍ"),
        ("jоhn@mаil.com hi", "email", "jоhn@mаil.com"),
        ("call plus one two one two five five five zero one two three", "phone", "plus one two one two five five five zero one two three"),
        ("vier eins eins eins eins eins eins eins eins eins eins eins eins eins eins eins", "card", None),
        ("john&#64;mail&#46;com", "email", None),
        ("john @ mail . com now", "email", "john @ mail . com"),
        ("john_at_mail_dot_com", "email", None),
        ("+1 (555) O12-3l45 x", "phone", "+1 (555) O12-3l45"),
        ("l92.168.O.l7 y", "ip", "l92.168.O.l7"),
        ("𝐣𝐨𝐡𝐧@𝐦𝐚𝐢𝐥.𝐜𝐨𝐦", "email", None),
        ("192 dot 168 dot 1 dot 17", "ip", "192 dot 168 dot 1 dot 17"),
        ("one nine two dot one six eight dot one dot seven!", "ip", "one nine two dot one six eight dot one dot seven"),
    ],
)
def test_disguised_identifiers_map_back_to_the_source(text, kind, part):
    base, spans = pii.all_spans(text)
    added = [s for s in spans if s not in base]
    assert (kind, part or text) in [(k, text[a:b]) for a, b, k in added]
    assert f"[{kind.upper()}]" in pii.redact(text, spans)


@pytest.mark.parametrize("text", ["we met at noon. The dot is at the end of it", "un des deux trois at the end", "der. in [at] dem", "Привет мир один", "one two three", "see foo @ bar. Next", "state-of-the-art dot product at noon"])
def test_plain_text_is_left_alone(text):
    assert pii.all_spans(text)[1] == []


@pytest.mark.parametrize(
    ("kind", "part"),
    [
        ("phone", "plus 1 two 1 two 5 five 5 five 0 one 2 three"),
        ("phone", "plus 1 (two 1 two) 5 dash five 5 five dash 0 one 2 three"),
        ("phone", "+1 two 1.two 5-five 5, five 0/one 2 three"),
        ("ip", "one dot 2 dot three dot 4"),
        ("ip", "one dot two dot three dot four"),
        ("card", "four 1 one 1 one 1 one 1 one 1 one 1 one 1 one 1"),
    ],
)
def test_names_and_numerals_may_alternate(kind, part):
    text = f"Note {part}; end"
    assert (kind, part) in [(k, text[a:b]) for a, b, k in pii.all_spans(text)[1]]


def test_a_word_of_prose_after_a_number_is_not_its_digit():
    base, spans = pii.all_spans("appelez +1 (848) 555-1373 Un an")
    assert base == spans


AT_SIGNS = {"literal": "@", "bracketed": " [at] ", "spelled": " at ", "hyphened": "_at_", "entity": "&#64;", "spaced": " @ "}
DOT_SIGNS = {"literal": ".", "bracketed": " (dot) ", "spelled": " dot ", "hyphened": "_dot_", "entity": "&#46;", "spaced": " . "}


@pytest.mark.parametrize("at", AT_SIGNS)
@pytest.mark.parametrize("first", DOT_SIGNS)
@pytest.mark.parametrize("second", DOT_SIGNS)
def test_every_mixture_of_signs_is_an_address(at, first, second):
    for part in (f"jane.doe{AT_SIGNS[at]}mail{DOT_SIGNS[first]}com", f"jane{AT_SIGNS[at]}mail{DOT_SIGNS[first]}co{DOT_SIGNS[second]}uk"):
        text = f"Write, {part}, or call"
        assert part in [text[a:b] for a, b, kind in pii.all_spans(text)[1] if kind == "email"]
        assert pii.redact(text, pii.all_spans(text)[1]) == "Write, [EMAIL], or call"


def test_spelled_dots_of_the_local_part_belong_to_the_address():
    text = "to jane dot van dot doe at mail.com"
    assert [text[a:b] for a, b, _ in pii.all_spans(text)[1]] == [text[3:]]


@pytest.mark.parametrize("text", ["look at example.com for more", "we met at noon.It was late", "foo@bar dot product", "see docs at https://look-at-me.com/x", "a talk at github.com/x/y", "ratio at 3.14 per cent", "list [at] top dot product", "please look at example dot com", "see it at home dot now", "looked at it"])
def test_mixed_signs_need_a_plausible_address(text):
    assert pii.all_spans(text)[1] == []


def test_kneser_ney_against_direct_sums(spark):
    rnd = random.Random(4)
    texts = [prose(rnd, rnd.randint(0, 60), "abc") for _ in range(80)]
    got = {r["doc_id"]: r for r in kneser_ney.lm_scores(docs(spark, texts), shards=3).collect()}
    token = {i: [*words(lower(t)), " end"] for i, t in enumerate(texts)}
    train = [i for i in token if zlib.crc32(str(i).encode()) % 7 != 2]
    uni, bi = Counter(w for i in train for w in token[i]), Counter()
    for i in train:
        bi.update(zip([" begin", *token[i]], token[i]))
    before = Counter(b for _, b in bi)
    disc = lambda c: kneser_ney.KneserNey.discounts(np.array([sum(x == k for x in c.values()) for k in (1, 2, 3, 4)]))
    d2, d1, follow = disc(bi), disc(before), defaultdict(list)
    for (a, _), c in bi.items():
        follow[a].append(c)
    n, v, types = sum(uni.values()), len(uni), len(bi)
    spread = sum(d1[min(c, 3)] for c in before.values()) / types
    low = lambda w: max(before[w] - d1[min(before[w], 3)], 0) / types + spread / (v + 1)
    assert sum(map(low, uni)) + spread / (v + 1) == pytest.approx(1)

    def p(a, b):
        if a not in follow:
            return low(b)
        total, c = sum(follow[a]), bi[a, b]
        return max(c - d2[min(c, 3)], 0) / total + sum(d2[min(x, 3)] for x in follow[a]) / total * low(b)

    for i, ws in token.items():
        r = got[i]
        assert (r["n_tokens"], r["n_known"], r["train_tokens"], r["held_out"]) == (len(ws), sum(w in uni for w in ws), n, i not in train)
        assert r["score"] == pytest.approx(sum(math.log10(p(a, b)) for a, b in zip([" begin", *ws], ws)))
        assert r["base_score"] == pytest.approx(sum(math.log10((uni[w] + 1) / (n + v + 1)) for w in ws))


def test_counts_above_a_byte_survive_the_arrays(spark):
    got = kneser_ney.lm_scores(docs(spark, ["a b " * 2000, "a b"]), shards=2).orderBy("doc_id").collect()
    assert got[0]["n_known"] == 4001 and got[0]["score"] / 4001 > -0.05


def longest_brute(ws):
    out = []
    for i in range(len(ws)):
        best = 0
        for j in range(len(ws)):
            k = 0
            while i != j and max(i, j) + k < len(ws) and ws[i + k] == ws[j + k]:
                k += 1
            best = max(best, k)
        out.append(best)
    return out


def maximal_brute(ws, least):
    """Every maximal repeated substring of ``least`` words or more, with where it starts: no word can be added on either side of all."""
    places = defaultdict(list)
    for i in range(len(ws)):
        for j in range(i + least, len(ws) + 1):
            places[tuple(ws[i:j])].append(i)
    out = {}
    for part, at in places.items():
        left = {ws[i - 1] if i else ("start", i) for i in at}
        right = {ws[i + len(part)] if i + len(part) < len(ws) else ("end", i) for i in at}
        if len(at) > 1 and len(left) > 1 and len(right) > 1:
            out[part] = at
    return out


@settings(max_examples=150, deadline=None)
@given(st.lists(st.lists(st.sampled_from("abc"), max_size=30), min_size=1, max_size=4), st.integers(1, 4))
def test_intervals_are_the_maximal_repeated_substrings(texts, least):
    ids = np.array([ord(w) for t in texts for w in t], np.int64)
    sizes = np.array([len(t) for t in texts])
    doc, ends = np.repeat(np.arange(len(texts)), sizes), np.repeat(np.cumsum(sizes), sizes)
    order = repetition.suffix_array(ids, doc, ends)
    lcp = repetition.common_prefixes(ids, ends, order, least)
    first, last, shared, parent, _ = repetition.lcp_intervals(lcp, least)
    top = repetition.maximal(ids, ends, order, first, last) if len(first) else []
    got, want = [], []
    for a, b, n, yes in zip(first, last, shared, top, strict=True):
        at = np.sort(order[a : b + 1])
        if yes:
            got.append((int(doc[at[0]]), "".join(map(chr, ids[at[0] : at[0] + n])), at.tolist()))
    for k, t in enumerate(texts):
        low = int(sizes[:k].sum())
        want += [(k, "".join(part), [low + i for i in at]) for part, at in maximal_brute(t, least).items()]
    assert sorted(got) == sorted(want)
    assert all(p == -1 or (first[p] <= a and b <= last[p] and shared[p] < n and p > k) for k, (a, b, n, p) in enumerate(zip(first, last, shared, parent, strict=True)))
    _, _, longest = repetition.repeats(ids, doc, ends, least)
    mark = repetition.covered(order, longest, len(ids)) if len(ids) else np.zeros(0, bool)
    assert set(np.flatnonzero(mark).tolist()) == {p for _, part, at in want for i in at for p in range(i, i + len(part))}


def test_repetition_against_brute_force(spark):
    rnd = random.Random(5)
    texts = [prose(rnd, rnd.randint(0, 50), "ab"[: rnd.randint(1, 2)]) + "\n#x\n#x\n" * rnd.randint(0, 2) for _ in range(60)]
    for r in repetition.quality_rules(docs(spark, texts)).collect():
        text = texts[r["doc_id"]]
        ws = words(text)
        longest = longest_brute(ws)
        trio = {p for i, k in enumerate(longest) if k >= 3 for p in range(i, i + 3)}
        far = {p for i, k in enumerate(longest) if k >= repetition.MIN_REPEAT_WORDS for p in range(i, i + k)}
        lines = [x for x in text.split("\n") if words(x)]
        top = max([0, *(len(x) for x in maximal_brute(ws, repetition.MIN_REPEAT_WORDS))])
        assert (r["n_words"], r["n_repeat_words"], r["n_covered_words"], r["longest_repeat"]) == (len(ws), len(trio), len(far), top)
        assert (r["word_chars"], r["n_symbols"], r["n_dup_lines"]) == (sum(map(len, ws)), sum(c in "#*$%&|<>" for c in text), len(lines) - len(set(lines)))
        assert r["base_failed"] == (len(ws) < 50 or 100 * len(trio) > 50 * len(ws))
        assert not (r["kept"] and r["base_failed"])


def test_repeated_passages_are_rejected_and_clean_text_is_kept(spark):
    rnd = random.Random(6)
    clean, passage = prose(rnd, 600), prose(rnd, 80)
    rows = repetition.quality_rules(docs(spark, [clean, f"{prose(rnd, 100)} {passage} {prose(rnd, 100)} {passage} {passage}"])).orderBy("doc_id").collect()
    assert [r["kept"] for r in rows] == [True, False]


def test_one_long_repeat_rejects_a_long_text_of_low_coverage(spark):
    rnd = random.Random(13)
    passages = [prose(rnd, n, "abcdefghijkl") for n in (2900, 120, 90)]
    texts = [f"{prose(rnd, 7000, 'abcdefghijkl')} {p} {prose(rnd, 7000, 'abcdefghijkl')} {p}" for p in passages]
    rows = repetition.quality_rules(docs(spark, texts)).orderBy("doc_id").collect()
    assert all(r["n_covered_words"] < repetition.MAX_COVERED * r["n_words"] and not r["base_failed"] for r in rows)
    assert [r["longest_repeat"] >= n for r, n in zip(rows, (2900, 120, 90), strict=True)] == [True] * 3
    assert [r["kept"] for r in rows] == [False, False, True]


@settings(max_examples=200, deadline=None)
@given(st.text(alphabet="ab c.\n'sé1́<|endoftext|> Σİß", max_size=200), st.integers(8, 60), st.integers(2, 8))
def test_token_ids_equal_the_library(text, chunk, overlap):
    known = tokens.word_ids(TOKENIZER)
    want = known.tokenizer.encode(text, add_special_tokens=False).ids
    assert known.ids(text.encode()).tolist() == want
    assert tokens.count_in_chunks(known.tokenizer, text, chunk, overlap) == len(want)


def test_huge_documents_are_counted_in_chunks(spark):
    rnd = random.Random(7)
    texts = [prose(rnd, 5000, "abcdeé,.1"), "y" * 3000, prose(rnd, 20)]
    known = tokens.word_ids(TOKENIZER)
    for r in tokens.token_counts(docs(spark, texts), TOKENIZER, chunk=500, overlap=16).collect():
        n = len(known.tokenizer.encode(texts[r["doc_id"]], add_special_tokens=False).ids)
        assert (r["n_tokens"], r["n_bytes"], r["over_limit"]) == (n, len(texts[r["doc_id"]].encode()), n > 2048)


def test_packing_is_a_partition_of_all_ids(spark):
    rnd = random.Random(8)
    texts = [prose(rnd, rnd.choice([0, 3, 40, 300, 3000])) for _ in range(150)]
    rows = packing.pack(docs(spark, texts).repartition(3), TOKENIZER, capacity=256).collect()
    known = tokens.word_ids(TOKENIZER)
    pieces, sequences = defaultdict(list), defaultdict(list)
    for r in rows:
        pieces[r["doc_id"]].append(r)
        sequences[r["sequence_id"]].append(r)
        assert r["length"] == len(r["ids"]) > 0 and r["ids_crc32"] == zlib.crc32(np.array(r["ids"], "<u4").tobytes())
    for i, text in enumerate(texts):
        want = [*known.ids(text.encode()).tolist(), 2]
        mine = sorted(pieces[i], key=lambda r: r["start"])
        assert [x for r in mine for x in r["ids"]] == want and all(r["doc_tokens"] == len(want) for r in mine)
        assert [r["start"] for r in mine] == [sum(r["length"] for r in mine[:k]) for k in range(len(mine))]
    for mine in sequences.values():
        at = 0
        for r in sorted(mine, key=lambda r: r["offset"]):
            assert r["offset"] == at
            at += r["length"]
        assert at <= 256


@settings(max_examples=100, deadline=None)
@given(st.lists(st.integers(1, 100), max_size=60))
def test_windows_hold_everything_within_capacity(sizes):
    found = packing.windows(sizes, 100)
    assert sorted(i for w in found for i in w) == list(range(len(sizes)))
    assert all(sum(sizes[i] for i in w) <= 100 for w in found)


def fold(text):
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", lower(text))


@pytest.mark.parametrize("block", [3, 100_000])
def test_decontamination_against_brute_force(spark, block):
    rnd = random.Random(9)
    items = [prose(rnd, rnd.choice([0, 1, 2, 5, 10, 30]), "ab") for _ in range(15)] + [None]
    texts = [prose(rnd, rnd.randint(0, 60), "ab") for _ in range(40)]
    texts = [f"{t} {rnd.choice(items[:-1]).upper()}! {t}" for t in texts]
    bench = spark.createDataFrame([(i, x) for i, x in enumerate(items)], "item_id long, text string")
    for r in decontam.decontaminate(docs(spark, texts), bench, block_windows=block).collect():
        ws, hit, found = fold(texts[r["doc_id"]]), set(), set()
        for i, item in enumerate(items):
            it = fold(item or "")
            for k in range(max(1, len(it) - 9)) if it else []:
                w = it[k : k + 10]
                for p in range(len(ws) - len(w) + 1):
                    if ws[p : p + len(w)] == w:
                        hit |= set(range(p, p + len(w)))
                        found.add(str(i))
        assert (r["n_words"], r["n_hit"], r["n_items"], r["contaminated"]) == (len(ws), len(hit), len(found), bool(hit))
        assert r["items_sha256"] == hashlib.sha256(",".join(sorted(found)).encode()).hexdigest()


def test_simhash_against_all_pairs(spark):
    rnd = random.Random(10)
    base = [prose(rnd, 120) for _ in range(25)]
    texts = base + [b.replace(b.split()[k], "zz", 1) for b in base for k in (3, 50)] + ["", "  ", None, "a", "A", "a b"]
    got = {r["doc_id"]: r for r in simhash.near_duplicates(docs(spark, texts)).collect()}
    fps = []
    for t in texts:
        ws = words(lower(t or ""))
        sh = [" ".join(ws[k : k + 3]) for k in range(max(1, len(ws) - 2))] if ws else []
        hs = [xxhash.xxh64_intdigest(s.encode(), 42) for s in sh]
        fps.append(sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hs) > len(hs)))
    root = list(range(len(fps)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for i in range(len(fps)):
        for j in range(i):
            if (fps[i] ^ fps[j]).bit_count() <= 3:
                a, b = sorted((find(i), find(j)))
                root[b] = a
    for i, fp in enumerate(fps):
        assert (got[i]["fingerprint"], got[i]["component_id"]) == (format(fp, "016x"), find(i))


@pytest.mark.parametrize("radius", [1, 2, 3])
def test_balls_meet_at_every_radius(radius):
    rng = np.random.default_rng(radius)
    fps = [int(x) for x in rng.integers(0, 2**63, 60)]
    fps += [f ^ sum(1 << int(b) for b in rng.choice(64, k, replace=False)) for f in fps for k in (1, 2, 3, 4)]
    fps = np.unique(np.array(fps, np.uint64))
    near = np.bitwise_count(fps[:, None] ^ fps[None, :]) <= radius
    want = simhash.forest(len(fps), *np.nonzero(near))
    rows = simhash.bucket_rows(3)
    found = [simhash.meet(fps, k, rows, radius) for k in range(8)]
    a, b = (np.concatenate(x) for x in zip(*found, strict=True))
    assert np.array_equal(simhash.forest(len(fps), a, b), want) and near[a, b].all()


def test_components_of_long_chains_and_stars(spark):
    edges = [(i, i + 1) for i in range(40)] + [(100, 100 + k) for k in range(1, 60)] + [(7, 7), (3, 2)]
    got = {r["node"]: r["root"] for r in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {i: 0 for i in range(41)} | {100 + k: 100 for k in range(60)}


ASSIGN = re.compile(r"""([pP][aA][sS][sS][wW][oO][rR][dD]|[pP][aA][sS][sS][wW][dD]|[sS][eE][cC][rR][eE][tT]|[tT][oO][kK][eE][nN]|[aA][pP][iI]_?[kK][eE][yY])["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""")


def base_secrets(text):
    out = [(m.start(), 0, "assign", m.end()) for m in ASSIGN.finditer(text) if len(m[2]) >= 6]
    out += [(m.start(), 1, "access", m.end()) for m in re.finditer("AKIA[A-Z0-9]+", text) if len(m[0]) >= 20]
    out += [(m.start(), 2, "hex", m.end()) for m in re.finditer("[0-9a-f]+", text) if len(m[0]) >= 24]
    return [f"{k}:{a}:{b}" for a, _, k, b in sorted(out)]


def test_secrets_against_the_patterns(spark):
    rnd = random.Random(11)
    bits = ["token", "PassWord", " = ", ":", '"', "'", "api_key", "AKIA", "ABCDEFGH12345678", "0a1b2c3d4e5f", "abc", "é", "", "\U0001f600", " ", "=", "x", "\n", "ſecret", "secret"]
    texts = ["".join(rnd.choice(bits) for _ in range(rnd.randint(0, 25))) for _ in range(400)] + ["password: token: abcdefgh"]
    for r in secrets.find_secrets(docs(spark, texts)).collect():
        want = base_secrets(texts[r["doc_id"]])
        assert r["base_sha256"] == hashlib.sha256(",".join(want).encode()).hexdigest()
        assert set(want) <= set(r["spans"].split(",")) or not want
        assert [r["n_assign"], r["n_access"], r["n_hex"]] == [sum(w.startswith(k) for w in want) for k in ("assign", "access", "hex")]


def test_ownership_separates_copied_examples_from_live_secrets(spark):
    shared, own = "ghp_" + "a1B2" * 10, "ghp_" + "Z9y8" * 10
    texts = [f"use {shared} here"] * 6 + [f"use {own} here", f"token = {shared[4:20]}"]
    rows = {r["doc_id"]: r for r in secrets.find_secrets(docs(spark, texts, source=lambda k: f"o{k}/repo")).collect()}
    assert "provider" not in rows[0]["spans"] and "provider:4:48" in rows[6]["live_spans"]
    assert rows[7]["n_assign"] == 1 and rows[7]["n_live"] == 1


def test_wide_copying_is_judged_by_holders_and_distinct_texts(spark):
    copied, hot, common = "ghp_" + "a1B2" * 10, "ghp_" + "Z9y8" * 10, "ghp_" + "Q7w6" * 10
    texts = [f"use {copied} here"] * 2 + [f"case {k} of {hot}" for k in range(30)] + [f"see {common} in {k}" for k in range(5)]
    sources = ["alpha", "beta"] + ["big"] * 30 + [f"s{k}" for k in range(5)]
    rows = {r["doc_id"]: r for r in secrets.find_secrets(docs(spark, texts, source=lambda k: sources[k])).collect()}
    assert rows[0]["live_spans"] == rows[1]["live_spans"] == "opaque:4:48,provider:4:48" and "provider:4:48:1:1:1" in rows[0]["holders"].split(",")
    assert all(rows[k]["spans"] == "" and rows[k]["holders"].endswith(":1:1:30") for k in range(2, 32))
    assert all(rows[k]["spans"] == "" and rows[k]["holders"].endswith(":5:5:5") for k in range(32, 37))


def test_toxicity_learns_words_and_prefixes(spark):
    rnd = random.Random(12)
    texts, labels = [], []
    for i in range(400):
        toxic = i % 4 == 0
        ws = prose(rnd, 60).split()
        for _ in range(3 * toxic):
            ws[rnd.randrange(60)] = rnd.choice(["nasty", "vilegoop" + rnd.choice("abcdef")])
        texts.append(" ".join(ws))
        labels.append((i, int(toxic)))
    got = toxicity.toxicity(docs(spark, texts), spark.createDataFrame(labels, "doc_id long, toxic int")).collect()
    held = [r for r in got if r["held_out"]]
    assert all(r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 3 == 1) and r["predicted"] == int(r["score"] >= 0.7) and 0 <= r["score"] <= 1 for r in got)
    assert sum(r["predicted"] == int(r["doc_id"] % 4 == 0) for r in held) / len(held) > 0.95


def test_chat_roles_markers_and_blocks(spark):
    rows = []
    for c in range(30):
        for t in range(9):
            role = "system" if t == 0 else ("user" if t % 2 else "assistant")
            rows.append((c, t, role, {"system": "Be kind.", "user": f"What is {t} and {c}?", "assistant": f"It is {t}. " * 30}[role]))
    rows += [(99, t, None, x) for t, x in enumerate(["Human: hi there", "Assistant: hello", "### Human: again"])] + [(None, None, "user", None), (99, 0, None, "Human: hi there")]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    got = chat.format_chats(df).collect()
    assert len(got) == len(rows)
    held = [r for r in got if r["held_out"] and r["given_role"] and r["conv_id"] is not None and r["conv_id"] < 99]
    assert held and all(r["role"] == r["given_role"] for r in held)
    marked = {r["turn"]: r for r in got if r["conv_id"] == 99}
    assert [marked[k]["role"] for k in range(3)] == ["user", "assistant", "user"] and marked[0]["rendered"] == "<|user|>\nhi there<|end|>\n"
    assert chat.format_chats(df.limit(0)).collect() == []


def test_blocks_are_bounded_by_segments_and_keep_the_order(spark, monkeypatch):
    monkeypatch.setattr(chat, "BLOCK_ROWS", 20)
    turns = [0] * 500 + [1, 2, 3] * 15 + list(range(4, 60)) + [60] * 90 + [2000] * 3
    rows = [("7", t, hashlib.sha256(str(k).encode()).digest(), 0, 1) for k, t in enumerate(turns)] + [("8", t, b"abcd", 0, 1) for t in range(30)]
    giants = [("7", t, hashlib.sha256(x.encode()).digest(), k, 130) for t, x in ((2, "x"), (2, "y"), (70, "z"), (-1, "v")) for k in range(130)]
    got = chat.in_blocks(spark.createDataFrame(rows + giants, "conv_id string, turn long, row_id binary, part int, parts int")).collect()
    key = lambda r: (r["conv_id"], *(r[k] for k in chat.BLOCK))
    assert sorted((r["conv_id"], r["turn"], bytes(r["row_id"]), r["part"], r["parts"]) for r in got) == sorted(rows + giants)
    assert max(Counter(map(key, got)).values()) <= 2 * chat.BLOCK_ROWS
    keys = [key(r) for r in sorted(got, key=lambda r: (r["conv_id"], r["turn"], r["parts"] > 40, r["row_id"], r["part"]))]
    assert keys == sorted(keys)


@pytest.mark.parametrize(
    ("text", "want"),
    [
        ("Human: Answer: 42 is mine", [("user", True, "Answer: 42 is mine")]),
        ("Human: first question\nAssistant: first answer\nwith a line\n\nHuman: second question", [("user", True, "first question"), ("assistant", True, "first answer\nwith a line"), ("user", True, "second question")]),
        ("\n  \n### System:\nBe kind.\n<|user|>\nHi\n", [("system", True, "Be kind."), ("user", True, "Hi\n")]),
        ("User: see\n```\nbot: x\n```\ndone\nBot: ok", [("user", True, "see\n```\nbot: x\n```\ndone"), ("assistant", True, "ok")]),
        ("[INST] one [/INST] two\n[/INST] three", [("user", True, "one [/INST] two"), ("assistant", True, "three")]),
    ],
)
def test_transcripts_in_one_text_are_split_into_turns(spark, text, want):
    talk = [(c, t, ["user", "assistant"][t % 2], f"Turn {t} of {c}?" if t % 2 == 0 else f"It is {t}. " * 9) for c in range(12) for t in range(4)]
    df = spark.createDataFrame([*((str(c), t, r, x) for c, t, r, x in talk), ("chat-x", 0, None, text)], "conv_id string, turn long, role string, text string")
    got = sorted((r for r in chat.format_chats(df).collect() if r["conv_id"] == "chat-x"), key=lambda r: r["part"])
    assert [(r["role"], r["had_marker"], r["rendered"]) for r in got] == [(role, marked, f"<|{role}|>\n{said}<|end|>\n") for role, marked, said in want]


def test_parsing_against_every_path(spark):
    """Random transcripts: segments from a plain reading of lines, roles from trying all paths, turns put together by hand."""
    rnd = random.Random(21)
    marks = {"User: ": 1, "### Assistant: ": 2, "System: ": 0, "Answer: ": 2, "": None, "- ": None}
    line = lambda: rnd.choice(list(marks)) + rnd.choice(["how so?", "yes", "it is. " * 12, "Bot: quoted", "    code"])
    rows = [(c, rnd.choice([0, 1, 2, None]), rnd.choice([*chat.ROLES, None]), "\n".join(line() for _ in range(rnd.randint(1, 3)))) for c in range(40) for _ in range(2)]
    rows += [(200 + c, t, chat.ROLES[t and 1 + t % 2], ["Be kind", "why?", "it is. " * 12][t and 1 + t % 2]) for c in range(20) for t in range(5)]
    df = spark.createDataFrame([*rows, rows[0], (None, 3, None, "User: alone\nBot: hi")], "conv_id long, turn long, role string, text string")
    models = []
    known = chat.learn

    def without_ties(rows):
        models.append(known(rows))
        for table in [*models[-1].show.values(), models[-1].first]:
            table += np.random.default_rng(4).normal(0, 1e-3, table.shape)
        return models[-1]

    chat.learn = without_ties
    try:
        got = chat.format_chats(df).collect()
    finally:
        chat.learn = known
    model = models[0]

    def parse(text):
        out = []
        for n, x in enumerate(text.split("\n")):
            mark = next((m for m in marks if m.strip() and marks[m] is not None and x.startswith(m)), None)
            if mark is None and x.startswith("Bot: "):
                mark = "Bot: "
            if n and mark is None:
                out[-1][1] += "\n" + x
            else:
                role = 2 if mark == "Bot: " else marks[mark] if mark else None
                out.append([role, x, x[len(mark or "") :].lstrip()if mark else x])
        return [(role, whole, whole[len(whole.split("\n")[0]) - len(first) :] if role is not None else whole) for role, whole, first in out]

    def score(seg, k, state):
        role, _, said = seg
        e = sum(table[state % 3][v] for (_, table), v in zip(model.show.items(), chat.features(said), strict=True))
        if k == 0:
            return chat.IMPOSSIBLE if state > 2 else e + model.first[state][0 if role is None else role + 1]
        return e + (model.inner[state][role] if state < 3 else -math.log(3))

    talks = defaultdict(list)
    for c, t, _, x in {(c, t, None, x) for c, t, _, x in rows}:
        talks[c].append((-1 if t is None else t, hashlib.sha256(x.encode()).hexdigest(), x))
    checked = 0
    for c, mine in talks.items():
        segs = [(t, x, k, seg) for t, _, x in sorted(mine) for k, seg in enumerate(parse(x))]
        best = {s: (model.start[s] + score(segs[0][3], 0, s), [s]) for s in range(6)}
        for _, _, k, seg in segs[1:]:
            best = {s: max(((v + model.step[p, s] + score(seg, k, s), [*path, s]) for p, (v, path) in best.items()), key=lambda x: x[0]) for s in range(6)}
        path = max(best.values(), key=lambda x: x[0])[1]
        turns = []
        for (t, x, k, seg), state in zip(segs, path, strict=True):
            if state < 3:
                turns.append([t, x, state, seg[2], k + 1 < len(parse(x))])
            else:
                turns[-1][3] = x[x.rindex(turns[-1][3]) :][: len(turns[-1][3]) + 1 + len(seg[1])]
        want = Counter()
        for n, (t, x, role, said, _) in enumerate(turns):
            more = n + 1 < len(turns) and turns[n + 1][:2] == [t, x]
            want[t, f"<|{chat.ROLES[role]}|>\n{said.rstrip() if more else said}<|end|>\n"] += 1
        have = {(-1 if r["turn"] is None else r["turn"], r["rendered"]) for r in got if r["conv_id"] == c}
        assert have == set(want), (c, have ^ set(want))
        checked += 1
    assert checked == 60
    assert [r["role"] for r in got if r["conv_id"] is None] == ["user", "assistant"]


def test_segments_without_a_conversation_do_not_change_each_other(spark):
    talk = [(c, t, ["user", "assistant"][t % 2], f"Turn {t} of {c}") for c in range(10) for t in range(6)]
    loose = [(None, None, None, f"Something {k}") for k in range(7)]
    df = spark.createDataFrame(talk + loose, "conv_id long, turn long, role string, text string")
    got = [r["role"] for r in chat.format_chats(df).collect() if r["conv_id"] is None]
    assert len(got) == 7 and len(set(got)) == 1


def test_viterbi_in_blocks_equals_one_pass():
    rng = np.random.default_rng(3)
    step, start = np.log(rng.dirichlet(np.ones(6), 6)), np.log(rng.dirichlet(np.ones(6)))
    e = np.log(rng.dirichlet(np.ones(6), 50))
    score, back = start + e[0], []
    for x in e[1:]:
        options = score[:, None] + step
        back.append(options.argmax(axis=0))
        score = options.max(axis=0) + x
    path = [int(score.argmax())]
    for b in reversed(back):
        path.append(int(b[path[-1]]))
    parts = [e[:20], e[20:21], e[21:50]]
    ends = chat.block_ends([chat.block_matrix(p, step) for p in parts], start, step)
    assert [s for p, (a, b) in zip(parts, ends, strict=True) for s in chat.best_path(p, step, a, b)] == path[::-1]


def brute_secrets(rows):
    """find_secrets by nested loops: rows of (text, source) to (spans, live spans, holders)."""
    found = []
    for text, _ in rows:
        mine = [(m.start(), 0, "assign", m.end(), m[2]) for m in ASSIGN.finditer(text) if len(m[2]) >= 6]
        mine += [(m.start(), 1, "access", m.end(), m[0]) for m in re.finditer("AKIA[A-Z0-9]+", text) if len(m[0]) >= 20]
        mine += [(m.start(), 2, "hex", m.end(), m[0]) for m in re.finditer("[0-9a-f]+", text) if len(m[0]) >= 24]
        mine += [(m.start(), 3, kind, m.end(), m[0]) for kind, pattern in secrets.FURTHER.items() for m in re.finditer(pattern, text)]
        found.append(sorted(mine))
    places = defaultdict(list)
    for (text, source), mine in zip(rows, found, strict=True):
        for *_, value in mine:
            places[value].append((text, source))
    out = []
    for mine in found:
        spans, live, holders = [], [], []
        for start, rank, kind, end, value in mine:
            first = {}
            for text, source in places[value]:
                first[text] = min(first.get(text, source), source)
            repos, owners = set(first.values()), {s.split("/")[0] for s in first.values()}
            alive = len(owners) <= secrets.MAX_OWNERS and len(repos) <= secrets.MAX_REPOS and len(first) <= secrets.MAX_TEXTS and len({s.split("/")[0] for _, s in places[value]}) <= secrets.MAX_COPY_OWNERS
            holders.append(f"{kind}:{start}:{end}:{len(repos)}:{len(owners)}:{len(first)}")
            spans += [f"{kind}:{start}:{end}"] * (rank < 3 or alive)
            live += [f"{kind}:{start}:{end}"] * alive
        out.append((",".join(spans), ",".join(live), ",".join(holders)))
    return out


def test_secrets_of_repeated_rows_and_every_kind_against_brute_force(spark):
    rnd = random.Random(14)
    letters = "abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789"
    some = lambda n: "".join(rnd.choice(letters) for _ in range(n))
    pool = ["token = abcdef123", "password: hunter22x", "ghp_" + some(36), "glpat-" + some(20), f"eyJ{some(9)}.eyJ{some(9)}.{some(9)}", f"db://{some(3)}:{some(8)}@h", f"db://{some(90)}:{some(150)}@h", "z" * 71 + "1" + some(40) + "aB", some(33) + "==", "0123456789abcdef" * 2, "AKIA" + "Q" * 16]
    texts = [" then ".join(rnd.choice([*pool, some(40), "plain words"]) for _ in range(rnd.randint(0, 5))) for _ in range(120)]
    rows = [(t, rnd.choice(["a/x", "a/y", "b/x", "c/x", "d/z", "e/e", "f/f"])) for t in texts]
    rows += [("my text then token = abcdef123 and password: hunter22x end", s) for s in ("a/x", "a/x", "b/x")] + rows[:20] + [(t, "zz/1") for t, _ in rows[:20]]
    rows += [(f"hot example {pool[2]}", "hot/repo")] * 60
    given = spark.createDataFrame([(k // 2 if k < 40 else None if k % 9 == 0 else 7, t, s) for k, (t, s) in enumerate(rows)], "doc_id long, text string, source string")
    got = Counter((r["doc_id"], r["spans"], r["live_spans"], r["holders"], r["n_assign"]) for r in secrets.find_secrets(given).collect())
    want = Counter()
    for k, (spans, live, holders) in enumerate(brute_secrets(rows)):
        want[k // 2 if k < 40 else None if k % 9 == 0 else 7, spans, live, holders, spans.count("assign:")] += 1
    assert got == want


@pytest.fixture
def heavy_from_the_first_row(monkeypatch):
    monkeypatch.setattr(runtime, "HEAVY_ROWS", 0)
    monkeypatch.setattr(runtime, "HEAVY_SHARE", 1 / 20)


@pytest.mark.usefixtures("heavy_from_the_first_row")
def test_operators_with_heavy_keys_against_brute_force(spark):
    test_simhash_against_all_pairs(spark)
    test_components_of_long_chains_and_stars(spark)
    test_secrets_of_repeated_rows_and_every_kind_against_brute_force(spark)


@pytest.mark.usefixtures("heavy_from_the_first_row")
def test_join_counted_splits_heavy_keys(spark):
    rows = [(k % 3000 if k % 2 else 5, k) for k in range(9000)] + [(None, -1)]
    counts = Counter(k for k, _ in rows if k is not None)
    left = spark.createDataFrame(rows, "k long, v long")
    right = spark.createDataFrame([(k, n, k * k) for k, n in counts.items()], "k long, n long, s long")
    got = sorted(tuple(r) for r in join_counted(left, right, "k", "n").select("k", "v", "s").collect())
    assert got == sorted((k, v, k * k) for k, v in rows if k is not None)


def planted_disguises(rnd, n):
    """Identifiers behind disguises of every kind, with what each is."""
    swap = {v: k for k, v in pii.LOOKALIKES.items()}
    spelled = [names.split() for names in pii.DIGIT_NAMES]
    for _ in range(n):
        local, host, top = (rnd.choice(x) for x in (["jane.doe", "k_lee7", "info", "m-smith"], ["mail", "uni-x", "shop24"], ["com", "org", "co.uk", "de"]))
        digits = "".join(rnd.choice("0123456789") for _ in range(10))
        names = rnd.choice(spelled)
        yield "email", f"{local}{rnd.choice(list(AT_SIGNS.values())[1:])}{host}{rnd.choice(list(DOT_SIGNS.values())[1:])}{top.split('.')[0]}"
        address = f"{local}@{host}.{top}"
        yield "email", "".join(swap.get(c, c) if k == spot else c for spot in [next(i for i, c in enumerate(address) if c in swap)] for k, c in enumerate(address))
        yield "email", "".join(chr(ord(c) + 0xFEE0) for c in address)
        yield "email", address[:3] + "​" + address[3:]
        yield "phone", "plus " + " ".join(names[int(d)] for d in "1" + digits)
        yield "phone", "+1 " + " ".join(names[int(d)] if k % 2 else d for k, d in enumerate(digits[:9]))
        yield "phone", "+49 " + digits[:3] + " " + digits[3:].replace("0", "O").replace("1", "l") if digits[3:].count("0") + digits[3:].count("1") in (1, 2, 3) else "+١٢٣٤٥٦٧٨٩٠١"
        yield "ip", " dot ".join(str(rnd.randrange(256)) for _ in range(4))


def test_recall_and_precision_on_planted_disguises():
    rnd = random.Random(20)
    prose = ["The cat sat at home and one of two dogs ran to a dot on page three of four", "Nine people looked at it for one two minutes", "Please look at example dot com or at the dot above it", "Seven of 12 came at noon. One dot was left at the end", "We met at 10.30 at the corner; plus one guest"]
    planted = found = false = 0
    for kind, part in planted_disguises(rnd, 150):
        before, after = rnd.choice(prose), rnd.choice(prose)
        text = f"{before}; {part}; {after}"
        base, spans = pii.all_spans(text)
        added = [s for s in spans if s not in base]
        low = len(before) + 2
        mine = [s for s in added if s[2] == kind and s[0] <= low and s[1] >= low + len(part)]
        planted, found, false = planted + 1, found + bool(mine), false + sum(not low <= s[0] < low + len(part) for s in added)
        assert pii.all_spans(f"{before}; {after}")[1] == []
    print(f"planted {planted}, found {found}, false {false}")
    assert found >= 0.98 * planted and false <= 0.01 * planted


@pytest.mark.parametrize("unit", ["a-at-", "a at ", "[at]", "a.", "one ", "1 (", "a@", "@ ", "&#64;", "a​", "plus one dot ", "_dot_b"])
def test_time_stays_linear_in_long_texts(unit):
    text = "x [at] y " + unit * (300_000 // len(unit))
    began = time.process_time()
    pii.all_spans(text)
    assert time.process_time() - began < 20


def test_spans_of_chained_rewritings_map_back():
    text = pii.Rewritten("abcdef").replace([(1, 3, "X"), (3, 4, ""), (5, 6, "YZ")]).replace([(0, 2, "__"), (2, 3, "E")])
    assert text.text == "__EYZ" and [text.source(k, k + 1) for k in range(5)] == [(0, 3), (0, 3), (4, 5), (5, 6), (5, 6)]


def test_personal_data_of_repeated_rows_and_kept_columns(spark):
    text = "write a.b@c.org or jane at mail dot com, please"
    given = docs(spark, [text, text, None], [1, 1, None])
    rows = pii.find_personal_data(given, ["doc_id", "text", "spans"], redacted=True).collect()
    assert [r["__redacted"] for r in rows] == ["write [EMAIL] or [EMAIL], please"] * 2 + [None]


def test_kept_columns_with_the_names_of_results_give_way(spark):
    given = docs(spark, ["some text here", None]).withColumns({n: F.lit("old") for n in ("n_words", "n_hit", "contaminated", "n_email", "__hits", "__text")})
    bench = spark.createDataFrame([(1, "text here")], "item_id long, text string")
    rows = decontam.contamination(given, bench, ["doc_id", "text", "n_words", "n_hit", "__hits", "contaminated"], block_windows=1).orderBy("doc_id").collect()
    assert [(r["doc_id"], r["text"], r["n_words"], r["n_hit"]) for r in rows] == [(0, "some text here", 3, 2), (1, None, 0, 0)]
    rows = repetition.text_measures(given, ["text", "doc_id", "n_words", "__text"]).orderBy("doc_id").collect()
    assert [(r["doc_id"], r["text"], r["n_words"]) for r in rows] == [(0, "some text here", 3), (1, None, 0)]
    assert [r["n_email"] for r in pii.find_personal_data(given, ["doc_id", "n_email", "words"]).collect()] == [0, 0]


def small_network(seed):
    rng = np.random.default_rng(seed)
    model = toxicity.noise(rng)
    model.table, model.out = model.table.astype(np.float64), model.out.astype(np.float64)
    model.filters, model.bias = [f.astype(np.float64) for f in model.filters], [rng.normal(0, 0.1, b.shape) for b in model.bias]
    return model, rng


def logit_brute(model, embedded, place):
    """The network word by word, window by window and filter by filter."""
    total = model.constant
    for k, w in enumerate(toxicity.WIDTHS):
        for f in range(toxicity.FILTERS):
            values = [sum(float(embedded[place[p + o]] @ model.filters[k][o][:, f]) for o in range(w)) + model.bias[k][f] for p in range(len(place) - w + 1)]
            for n, v in enumerate(sorted(values, reverse=True)[: toxicity.POOLED]):
                total += max(v, 0) * model.out[k, n, f]
    return total


@pytest.mark.parametrize("n_words", [1, 2, 5, 30])
def test_forward_pass_and_gradients_against_brute_force(n_words):
    model, rng = small_network(n_words)
    embedded = rng.normal(0, 1, (max(1, n_words // 2), toxicity.DIM))
    place = rng.integers(0, len(embedded), n_words) if n_words > 1 else np.zeros(1, np.int64)
    responses = [np.stack([embedded @ f[o] for o in range(w)]) for w, f in zip(toxicity.WIDTHS, model.filters, strict=True)]
    assert model.logit(model.pooled(responses, place)[0]) == pytest.approx(logit_brute(model, embedded, place))
    loss = lambda label: 1.7 * -math.log(1 / (1 + math.exp(-logit_brute(model, embedded, place) * (1 if label else -1))))
    for label in (0, 1):
        g = toxicity.gradient(model, embedded, place, label, 1.7)
        pairs = [(model.out, g.out), (embedded, g.words), *zip(model.filters, g.filters, strict=True), *zip(model.bias, g.bias, strict=True)]
        for value, grad in pairs:
            for spot in rng.integers(0, value.size, 6):
                at = np.unravel_index(spot, value.shape)
                old, h = value[at], 1e-6
                value[at] = old + h
                up = loss(label)
                value[at] = old - h
                down = loss(label)
                value[at] = old
                assert grad[at] == pytest.approx((up - down) / (2 * h), abs=2e-5)


def test_training_rows_are_bounded_and_single(spark):
    given = docs(spark, ["x" * 100] * 30 + ["first", "second", "first"], [*range(30), 3, 3, 3])
    marks = spark.createDataFrame([(i, i % 2) for i in range(40)], "doc_id long, toxic int")
    rows = toxicity.training_rows(given, marks, bound=5)
    assert len(rows) <= 10 and len({r["doc_id"] for r in rows}) == len(rows)
    assert all(zlib.crc32(str(r["doc_id"]).encode()) % 3 != 1 for r in rows)
    assert sum(len(r["text"]) for r in toxicity.training_rows(given, marks, max_bytes=450)) <= 450


def test_long_texts_are_counted_and_scored_in_parts(spark, monkeypatch):
    rnd = random.Random(22)
    texts = [prose(rnd, 400_000, "abcdefgh"), prose(rnd, 300, "abcdefgh"), "one two"]
    want = {r["doc_id"]: r for r in kneser_ney.lm_scores(docs(spark, texts), shards=2).collect()}
    assert sum(len(t) for t in texts) > 1 << 20
    monkeypatch.setattr(kneser_ney, "SHARD_BYTES", 100_000)
    for r in kneser_ney.lm_scores(docs(spark, texts)).collect():
        assert (r["n_tokens"], r["n_known"], r["train_tokens"]) == tuple(want[r["doc_id"]][k] for k in ("n_tokens", "n_known", "train_tokens"))
        assert r["score"] == pytest.approx(want[r["doc_id"]]["score"]) and r["n_tokens"] == len(words(texts[r["doc_id"]])) + 1


def test_other_tokenizer_files_are_left_to_the_library(spark):
    rnd = random.Random(23)
    path = public_tokenizers.path("byte_bpe_50k.json")
    texts = [prose(rnd, 3000, "abc'dé 1."), "Don't <|endoftext|> stop", "", "  two  spaces\n"]
    plain = tokens.load_tokenizer(path)
    for r in tokens.token_counts(docs(spark, texts), path, chunk=500, overlap=16).collect():
        assert r["n_tokens"] == len(plain.encode(texts[r["doc_id"]], add_special_tokens=False).ids)
    assert tokens.splits_alike(TOKENIZER) and not tokens.splits_alike(path)
