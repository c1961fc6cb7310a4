"""Toxicity by a convolutional text classifier: hashed word embeddings, several filter widths and max pooling, trained in numpy."""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterator
from dataclasses import dataclass, field
from itertools import chain, count

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from terrasheaf.llm.common import Memo, runs, texts_of
from terrasheaf.llm.decontam import words_of

#: Rows of the embedding table; row 0 stands for nothing.
BUCKETS = 1 << 16
DIM = 12
FILTERS = 12
WIDTHS = (1, 2, 3)
#: The largest values of a filter that pooling keeps.
POOLED = 3
#: Lengths of the prefixes that are hashed beside the whole word.
PREFIXES = (4, 5, 6, 7)
IDS = 1 + len(PREFIXES)
#: Labelled rows of each label that training uses at most, taken by a hash of the id, and the bytes of text that these have at most.
MAX_TRAIN_ROWS = 2000
MAX_TRAIN_BYTES = 64 << 20
#: A text of more than this part of the bytes is not learnt from.
LONG_SHARE = 64
#: Passes over the rows, the share of a text's distinct words that each pass leaves out, and the size of steps.
EPOCHS, DROPPED, RATE, TABLE_RATE = 6, 0.3, 0.15, 1.5
THRESHOLD = 0.7


def bucket_ids(word: bytes) -> tuple[int, ...]:
    """Rows of the embedding table for a word and its prefixes."""
    text = word.decode(errors="replace").lower()
    keys = [text] + [f"{text[:n]}-" if len(text) >= n else "" for n in PREFIXES]
    return tuple(1 + xxhash.xxh64_intdigest(k.encode()) % (BUCKETS - 1) if k else 0 for k in keys)


def word_rows(memo: Memo, texts: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """For some texts: bucket rows of their distinct words, the words' places therein, and each text's number of words."""
    words = [words_of(t) for t in texts]
    number: dict[bytes, int] = defaultdict(count().__next__)
    total = sum(map(len, words))
    place = np.fromiter(map(number.__getitem__, chain.from_iterable(words)), np.int64, total)
    rows = np.array(list(map(memo.__getitem__, number)), np.int64).reshape(-1, IDS)
    return rows, place, np.array([len(w) for w in words], np.int64)


def top(values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The ``POOLED`` largest values of each column and where they are; zeros (place -1) where there are fewer."""
    n = len(values)
    k = min(POOLED, n)
    at = np.argpartition(values, n - k, axis=0)[n - k :] if n > k else np.arange(n)[:, None].repeat(values.shape[1], 1)
    best = np.take_along_axis(values, at, 0) if n else np.zeros((0, values.shape[1]), np.float32)
    order = np.argsort(-best, axis=0)
    best, at = np.take_along_axis(best, order, 0), np.take_along_axis(at, order, 0)
    if k < POOLED:
        best = np.concatenate([best, np.zeros((POOLED - k, values.shape[1]), np.float32)])
        at = np.concatenate([at, np.full((POOLED - k, values.shape[1]), -1)])
    return best, at


@dataclass
class Model:
    """The network's weights, its calibration, and a threshold for each language."""

    table: np.ndarray
    filters: list[np.ndarray]
    bias: list[np.ndarray]
    out: np.ndarray
    constant: float = 0.0
    slope: float = 1.0
    centre: float = 0.0
    by_lang: dict[str, float] = field(default_factory=dict)

    def embed(self, rows: np.ndarray) -> np.ndarray:
        return self.table[rows].sum(axis=1)

    def responses(self, rows: np.ndarray) -> list[np.ndarray]:
        """What each distinct word adds to each filter, by width and place in the window."""
        embedded = self.embed(rows)
        return [np.stack([embedded @ f[o] for o in range(w)]) for w, f in zip(WIDTHS, self.filters, strict=True)]

    def pooled(self, responses: list[np.ndarray], place: np.ndarray) -> tuple[np.ndarray, list[np.ndarray]]:
        """The pooled features of one text, and where they come from."""
        features, at = [], []
        for w, r, b in zip(WIDTHS, responses, self.bias, strict=True):
            n = len(place) - w + 1
            if n > 0:
                conv = r[0][place[:n]]
                for o in range(1, w):
                    conv = conv + r[o][place[o : o + n]]
                best, where = top(conv + b)
            else:
                best, where = np.zeros((POOLED, FILTERS), np.float32), np.full((POOLED, FILTERS), -1)
            features.append(np.maximum(best, 0))
            at.append(np.where(best > 0, where, -1))
        return np.stack(features), at

    def logit(self, features: np.ndarray) -> float:
        return float((features * self.out).sum() + self.constant)

    def probability(self, logits: np.ndarray) -> np.ndarray:
        """Calibrated so that the best cut of the training rows is at ``THRESHOLD``."""
        z = self.slope * (logits - self.centre) + np.log(THRESHOLD / (1 - THRESHOLD))
        return 1 / (1 + np.exp(-np.clip(z, -30, 30)))


def noise(rng: np.random.Generator) -> Model:
    """Weights to start from."""
    table = (0.05 * rng.standard_normal((BUCKETS, DIM))).astype(np.float32)
    table[0] = 0
    filters = [(rng.standard_normal((w, DIM, FILTERS)) / np.sqrt(w * DIM)).astype(np.float32) for w in WIDTHS]
    out = (0.3 * rng.standard_normal((len(WIDTHS), POOLED, FILTERS))).astype(np.float32)
    return Model(table, filters, [np.zeros(FILTERS, np.float32) for _ in WIDTHS], out)


@dataclass
class Gradient:
    """What the loss of one text changes by: for the weights after pooling, the filters and their biases, the constant, and the embeddings of
    the text's distinct words."""

    out: np.ndarray
    filters: list[np.ndarray]
    bias: list[np.ndarray]
    constant: float
    words: np.ndarray


def gradient(model: Model, embedded: np.ndarray, place: np.ndarray, label: int, weight: float) -> Gradient | None:
    """Of ``weight`` times the log loss of a text, whose distinct words' embeddings and their places are given; None if it has hardly any."""
    responses = [np.stack([embedded @ f[o] for o in range(w)]) for w, f in zip(WIDTHS, model.filters, strict=True)]
    features, at = model.pooled(responses, place)
    error = weight * (1 / (1 + np.exp(-np.clip(model.logit(features), -30, 30))) - label)
    if abs(error) < 1e-3:
        return None
    back, words, filters, bias = error * model.out, np.zeros_like(embedded), [], []
    for k, w in enumerate(WIDTHS):
        pool, filt = np.nonzero(at[k] >= 0)
        g, p = back[k][pool, filt], at[k][pool, filt]
        own = np.zeros_like(model.filters[k])
        for o in range(w):
            word = place[p + o]
            np.add.at(own[o].T, filt, g[:, None] * embedded[word])
            np.add.at(words, word, g[:, None] * model.filters[k][o].T[filt])
        filters.append(own)
        bias.append(np.bincount(filt, g, FILTERS))
    return Gradient(error * features, filters, bias, error, words)


class Trainer:
    """AdaGrad: every weight's step is scaled by its past gradients, those of an embedding by all of its row's."""

    def __init__(self, model: Model):
        self.model = model
        self.table = np.full(BUCKETS, 1e-3)
        self.out = np.full(model.out.shape, 1e-3)
        self.filters = [np.full(f.shape, 1e-3) for f in model.filters]
        self.bias = [np.full(b.shape, 1e-3) for b in model.bias]

    @staticmethod
    def move(value: np.ndarray, grad: np.ndarray, seen: np.ndarray, rate: float) -> None:
        seen += grad * grad
        value -= (rate * grad / np.sqrt(seen)).astype(value.dtype)

    def step(self, g: Gradient, rows: np.ndarray, rate: float) -> None:
        model = self.model
        self.move(model.out, g.out + 1e-4 * model.out, self.out, rate)
        model.constant -= 0.1 * rate * g.constant
        for k in range(len(WIDTHS)):
            self.move(model.filters[k], g.filters[k], self.filters[k], rate)
            self.move(model.bias[k], g.bias[k], self.bias[k], rate)
        touched = np.flatnonzero(np.abs(g.words).sum(axis=1))
        mine, grad = rows[touched], g.words[touched]
        np.add.at(self.table, mine, (grad * grad).sum(axis=1)[:, None])
        np.subtract.at(model.table, mine, ((TABLE_RATE * rate / np.sqrt(self.table[mine]))[:, :, None] * grad[:, None, :]).astype(np.float32))
        model.table[0] = 0


def fit(texts: list[bytes], labels: np.ndarray, langs: list[str | None]) -> Model:
    """Trains by stochastic gradients on four fifths of the rows; cut, slope and thresholds by language come from the others, whose labels
    nothing has seen before."""
    rng, memo = np.random.default_rng(5), Memo(bucket_ids)
    model = noise(rng)
    if len(set(labels.tolist())) < 2:
        model.constant = -20.0 if not labels.any() else 20.0
        return model
    order = rng.permutation(len(texts))
    n_test = max(1, len(texts) // 5)
    test, train = order[:n_test], order[n_test:]
    if len(set(labels[test].tolist())) < 2 or len(set(labels[train].tolist())) < 2:
        test = train = order  # too few rows to keep some back
    samples = [word_rows(memo, [t])[:2] for t in texts]
    share = labels[train].mean()
    weight = {1: 0.5 / share, 0: 0.5 / (1 - share)}
    trainer = Trainer(model)
    for epoch in range(EPOCHS):
        rate = RATE * (1 - epoch / EPOCHS)
        for i in rng.permutation(train):
            rows, place = samples[i]
            if len(place):
                embedded = model.embed(rows)
                embedded[rng.random(len(embedded)) < DROPPED] = 0
                g = gradient(model, embedded, place, int(labels[i]), weight[int(labels[i])])
                if g is not None:
                    trainer.step(g, rows, rate)
    logits = np.array([model.logit(model.pooled(model.responses(r), p)[0]) if len(p) else model.constant for r, p in (samples[i] for i in test)])
    model.centre = best_cut(logits, labels[test])
    spread = np.median(np.abs(logits - model.centre))
    model.slope = float(3 / spread) if spread > 0 else 1.0
    scores = model.probability(logits)
    for lang in sorted({x for x in langs if x is not None}):
        mine = np.array([langs[i] == lang for i in test])
        enough = mine.any() and labels[test][mine].any() and not labels[test][mine].all()
        model.by_lang[lang] = best_cut(scores[mine], labels[test][mine]) if enough else THRESHOLD
    return model


def best_cut(values: np.ndarray, labels: np.ndarray) -> float:
    """The cut with the best F1 of the upper side, in the middle of the gap it lies in."""
    order = np.argsort(-values)
    values, labels = values[order], labels[order]
    hits = np.cumsum(labels)
    f1 = 2 * hits / (np.arange(1, len(labels) + 1) + labels.sum())
    f1[:-1][values[:-1] == values[1:]] = -1
    k = int(np.argmax(f1))
    return float((values[k] + values[min(k + 1, len(values) - 1)]) / 2)


def held_out_rows(id_col: str = "doc_id", parts: int = 3, part: int = 1) -> Column:
    return F.coalesce(F.crc32(F.col(id_col).cast("string").cast("binary")) % parts == part, F.lit(False))


def training_rows(docs: DataFrame, labels: DataFrame, bound: int = MAX_TRAIN_ROWS, parts: int = 3, part: int = 1, max_bytes: int = MAX_TRAIN_BYTES) -> list:
    """At most ``bound`` labelled rows of each label outside the held-out part, the first by a hash of their id, one row for each id, and of
    these as many as have ``max_bytes`` of text. Texts of more than one part in ``LONG_SHARE`` of that are passed over, so a huge one costs no
    other its place. The sum runs over the sizes of those few rows; texts are fetched afterwards."""
    marks = labels.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("toxic").cast("int").alias("toxic")).where(F.col("toxic").isin(0, 1) & F.col("doc_id").isNotNull())
    marks = marks.where(~held_out_rows("doc_id", parts, part)).groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
    first = lambda y: marks.where(F.col("toxic") == y).orderBy(F.xxhash64("doc_id"), "doc_id").limit(bound)
    chosen = first(0).unionByName(first(1))
    lang = F.col("lang").cast("string") if "lang" in docs.columns else F.lit(None).cast("string")
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text.alias("text"), lang.alias("lang")).withColumn("hash", F.xxhash64("text"))
    sized = rows.withColumn("size", F.octet_length("text").cast("long")).where(F.col("size") <= max_bytes // LONG_SHARE)
    single = sized.join(F.broadcast(chosen), "doc_id").groupBy("doc_id").agg(F.min(F.struct("hash", "size", "toxic")).alias("r")).select("doc_id", "r.*")  # 2 * bound ids are broadcast
    so_far = F.sum("size").over(Window.orderBy(F.xxhash64("doc_id"), "doc_id").rowsBetween(Window.unboundedPreceding, Window.currentRow))
    taken = single.withColumn("bytes", so_far).where(F.col("bytes") <= max_bytes).select("doc_id", "hash", "toxic")
    return rows.join(F.broadcast(taken), ["doc_id", "hash"]).groupBy("doc_id", "hash", "toxic").agg(F.min("lang").alias("lang"), F.min("text").alias("text")).collect()  # one row an id


def toxicity(docs: DataFrame, labels: DataFrame, bound: int = MAX_TRAIN_ROWS, parts: int = 3, part: int = 1) -> DataFrame:
    """doc_id, held_out, score, predicted, and flagged: whether the score passes the threshold calibrated for the row's language.

    Learns from a bounded sample of labelled rows whose crc32 of the id is not ``part`` modulo ``parts``; the words of the text are the only
    input of a score. Null or empty text gets the score of a text without words; a null id is never held out nor learnt from; a null or
    unknown language takes the common threshold; a row labelled twice counts as toxic if it is so once; without labels of both sorts all
    scores are extreme alike; repeated rows stay; no rows give no rows; other columns are ignored.
    """
    spark = docs.sparkSession
    rows = sorted(training_rows(docs, labels, bound, parts, part), key=lambda r: (r["doc_id"], r["text"]))
    model = fit([r["text"].encode() for r in rows], np.array([r["toxic"] for r in rows], np.int64), [r["lang"] for r in rows])
    sent = spark.sparkContext.broadcast(model)  # a table of fixed size
    schema = pa.schema([("doc_id", pa.int64()), ("held_out", pa.bool_()), ("lang", pa.string()), ("score", pa.float64())])

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model, memo = sent.value, Memo(bucket_ids)
        for batch in batches:
            texts = texts_of(batch, "text")
            logits = np.full(len(texts), model.constant)
            memo.trim()
            for low, high in runs(texts):
                rows, place, sizes = word_rows(memo, texts[low:high])
                if len(place):
                    responses = model.responses(rows)
                    ends = np.cumsum(sizes)
                    for k, (a, b) in enumerate(zip((ends - sizes).tolist(), ends.tolist(), strict=True), low):
                        if a < b:
                            logits[k] = model.logit(model.pooled(responses, place[a:b])[0])
            columns = {"score": pa.array(model.probability(logits))}
            yield pa.RecordBatch.from_arrays([columns.get(n, batch.column(min(batch.schema.get_field_index(n), 3))) for n in schema.names], schema=schema)

    lang = F.col("lang").cast("string") if "lang" in docs.columns else F.lit(None).cast("string")
    given = docs.select(F.col("doc_id").cast("long").alias("doc_id"), held_out_rows("doc_id", parts, part).alias("held_out"), lang.alias("lang"), F.col("text").cast("string").alias("text"))
    scored = given.mapInArrow(score, "doc_id long, held_out boolean, lang string, score double")
    cut = F.lit(THRESHOLD)
    for name, value in model.by_lang.items():
        cut = F.when(F.col("lang") == name, F.lit(value)).otherwise(cut)
    return scored.select("doc_id", "held_out", "score", (F.col("score") >= THRESHOLD).cast("int").alias("predicted"), (F.col("score") >= cut).alias("flagged"))
