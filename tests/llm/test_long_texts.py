"""Whole texts of several slices: what stands at their very end is found."""

from __future__ import annotations

import random

import corpus_pipeline
import public_tokenizers
import pytest

from terrasheaf.llm import chat, decontam, kneser_ney, packing, repetition, secrets, simhash, tokens, toxicity

WORDS = 330_000


@pytest.fixture(scope="module")
def long():
    """About 2.3 MB of words, hardly any three of which come together twice."""
    rnd = random.Random(8)
    words = ["".join(rnd.choice("abcdefghij") for _ in range(rnd.randint(3, 9))) for _ in range(60_000)]
    return " ".join(rnd.choice(words) for _ in range(WORDS))


def frame(spark, *texts):
    return spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")


def row(df, doc_id=0):
    return df.where(f"doc_id = {doc_id}").first()


def test_quality_rules(spark, long):
    passage = " ".join(f"again{k}" for k in range(150))
    got = {r["doc_id"]: r for r in repetition.quality_rules(frame(spark, long, f"{passage} {long} {passage}")).collect()}
    assert (got[0]["n_words"], got[0]["kept"]) == (WORDS, True)
    assert got[1]["n_words"] == WORDS + 300 and not got[1]["kept"] and not got[1]["base_failed"]


def test_decontamination(spark, long):
    item = " ".join(f"item{k}" for k in range(25))
    items = spark.createDataFrame([(7, item)], "item_id long, text string")
    got = row(decontam.decontaminate(frame(spark, f"{long} {item}", long), items))
    assert (got["n_words"], got["n_hit"], got["n_items"]) == (WORDS + 25, 25, 1)
    assert not row(decontam.decontaminate(frame(spark, f"{long} {item}", long), items), 1)["contaminated"]


def test_near_duplicates(spark, long):
    got = {r["doc_id"]: r["component_id"] for r in simhash.near_duplicates(frame(spark, long, long + " one more word at the end", "something else")).collect()}
    assert got == {0: 0, 1: 0, 2: 2}


def test_secrets(spark, long):
    docs = frame(spark, f"{long} AKIA{'Q7' * 8} end").selectExpr("*", "'s' AS source")
    got = row(secrets.find_secrets(docs))
    assert got["n_access"] == 1 and f"access:{len(long) + 1}:{len(long) + 21}" in got["spans"]


def test_language_model(spark, long):
    got = row(kneser_ney.lm_scores(frame(spark, long, "a b c"), shards=2))
    assert got["n_tokens"] == WORDS + 1 and got["score"] < -WORDS


def test_toxicity(spark, long):
    docs = spark.createDataFrame([(0, long)] + [(k, "vile awful" if k % 2 else "kind words") for k in range(1, 40)], "doc_id long, text string")
    labels = spark.createDataFrame([(k, k % 2) for k in range(40)], "doc_id long, toxic int")
    got = {r["doc_id"]: r["score"] for r in toxicity.toxicity(docs, labels).collect()}
    assert len(got) == 40 and 0 <= got[0] <= 1


def test_packing_and_counts(spark, long):
    path = public_tokenizers.path("word_bpe_49k.json")
    n = row(tokens.token_counts(frame(spark, long), path))["n_tokens"]
    pieces = packing.pack(frame(spark, long), path, with_ids=False).collect()
    assert sum(r["length"] for r in pieces) == n + 1 == pieces[0]["doc_tokens"] and max(r["length"] for r in pieces) <= 4096


def test_chats(spark, long):
    rows = spark.createDataFrame([(1, 0, "user", f"User: {long}\nAssistant: yes"), (1, 1, "user", "and then?")], "conv_id long, turn int, role string, text string")
    text = "".join(str(v) for r in chat.format_chats(rows).collect() for v in r)
    assert long[-200:] in text and "Assistant: yes" not in text


def test_pipeline(spark, long, tmp_path):
    docs = [(0, long, "en", "s", len(long)), (1, long + " mail jane@example.org", "en", "s", 1), (2, " ".join(f"w{k}" for k in range(90)), "en", "s", 1)]
    spark.createDataFrame(docs, "doc_id long, text string, lang string, source string, n_chars long").write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([(1, "no such words here at all in any of the documents")], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    got = corpus_pipeline.run(spark, str(tmp_path)).collect()
    assert {r["doc_id"] for r in got} == {0, 2}
