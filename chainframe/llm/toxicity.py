"""Toxicity: FTRL-proximal logistic regression over hashed word n-grams and skip-grams.

Training reads a bounded, balanced sample of labelled rows. Shards of it are trained apart, each with per-coordinate
learning rates and L1, and their weights averaged; L1 leaves few weights, which are broadcast for
scoring. Scoring is one pass without a shuffle.
"""

from __future__ import annotations

import itertools
import zlib
from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from chainframe.llm.bpe import small
from chainframe.llm.common import chunks, free_name, materialize, text_of

#: ASCII punctuation and control characters part words; A-Z are lower-cased.
_WORD_BYTES = bytes(b + 32 if 65 <= b <= 90 else b if b > 127 or chr(b).isalnum() else 32 for b in range(256))


@dataclass(frozen=True)
class Ftrl:
    """Parameters. The sample has at most ``most_rows`` rows, half of them toxic as far as there are so many; all their
    features are learnt from, and L1 decides which keep a weight. The rarer label weighs up to ``most_weight`` times. Words
    count also by their first bytes (``stems``), so that inflected words share what is learnt, and what a text has twice or
    more counts once more. Stems, L1 and repeats were chosen by three folds within the training rows of sf0.1 and sf0.01."""

    bits: int = 20
    alpha: float = 1.0
    beta: float = 1.0
    l1: float = 32.0
    l2: float = 0.1
    epochs: int = 12
    most_rows: int = 12_000
    shard_rows: int = 4_000
    shard_chars: int = 64_000_000
    most_weight: float = 10.0
    skips: tuple[int, ...] = (1, 2)
    stems: tuple[int, ...] = (4, 5, 6, 7)
    threshold: float = 0.7


class WordHashes(dict):
    """Word -> number of its row in ``table``: hashes of the word and of its stems (0 where it is no longer than one)."""

    def __init__(self, stems: tuple[int, ...], most: int = 150_000):
        super().__init__()
        self.stems, self.most, self.fresh, self.table = stems, most, [], np.empty((0, 1 + len(stems)), np.uint64)

    def __missing__(self, word: bytes) -> int:
        self[word] = n = len(self)
        self.fresh.append((zlib.crc32(word), *(zlib.crc32(word[:k], k) if len(word) > k else 0 for k in self.stems)))
        return n

    def of(self, words: Iterable[bytes], n: int) -> np.ndarray:
        if len(self) > self.most:
            self.clear()
            self.table = self.table[:0]
        numbers = np.fromiter(map(self.__getitem__, words), np.int64, n)
        if self.fresh:
            self.table = np.concatenate([self.table, np.array(self.fresh, np.uint64)])
            self.fresh = []
        return self.table[numbers]


def features(texts: list[str], p: Ftrl, hashes: WordHashes) -> tuple[np.ndarray, np.ndarray]:
    """(text numbers, coordinates) of all words, their stems, neighbouring pairs (skip 0) and pairs with words skipped;
    with repeats."""
    words = [t.encode().translate(_WORD_BYTES).split() for t in texts]
    counts = np.array([len(w) for w in words], np.int64)
    table = hashes.of(itertools.chain.from_iterable(words), int(counts.sum()))
    h = table[:, 0]
    doc = np.repeat(np.arange(len(texts)), counts)
    rows, codes = [doc], [h * np.uint64(0x9E3779B97F4A7C15)]
    for k in range(len(p.stems)):
        there = table[:, k + 1] != 0
        rows.append(doc[there])
        codes.append((table[:, k + 1][there] + np.uint64(1 << (33 + k))) * np.uint64(0xD6E8FEB86659FD93))
    for skip in (0, *p.skips):
        step = skip + 1
        if len(h) > step:
            same = doc[:-step] == doc[step:]
            pair = (h[:-step] * np.uint64(0xC2B2AE3D27D4EB4F) + h[step:] + np.uint64(step)) * np.uint64(0x9E3779B97F4A7C15)
            rows.append(doc[:-step][same])
            codes.append(pair[same])
    return np.concatenate(rows), (np.concatenate(codes) >> np.uint64(64 - p.bits)).astype(np.int64)


def once_and_twice(pairs: np.ndarray, bits: int) -> np.ndarray:
    """Each feature (text number and coordinate in one number) once a text, and, at a coordinate of its own, each that a
    text has twice or more; sorted."""
    each, counts = np.unique(pairs, return_counts=True)
    again = each[counts > 1]
    mask = (1 << bits) - 1
    return np.unique(np.concatenate([each, again & ~mask | twice(again & mask, bits)]))


def twice(code: np.ndarray, bits: int) -> np.ndarray:
    """The coordinates of repeated features."""
    return ((code.astype(np.uint64) + np.uint64(1)) * np.uint64(0x9FB21C651E98DF25) >> np.uint64(64 - bits)).astype(np.int64)


def sigmoid(x):
    return 1 / (1 + np.exp(-np.clip(x, -35, 35)))


def train_shard(texts: list[str], labels: np.ndarray, p: Ftrl) -> tuple[np.ndarray, np.ndarray]:
    """(coordinates, weights) that aren't zero. Coordinate 2^bits is the bias; features count once a text."""
    bias = 1 << p.bits
    z, n = np.zeros(bias + 1), np.zeros(bias + 1)
    hashes, rows = WordHashes(p.stems), []
    for a, b in chunks(texts, 250_000):
        doc, code = features(texts[a:b], p, hashes)
        pairs = once_and_twice(doc << p.bits | code, p.bits)
        cuts = np.searchsorted(pairs, np.arange(b - a + 1) << p.bits)
        own = (pairs & (bias - 1)).astype(np.int32)
        rows += [np.append(own[x:y], np.int32(bias)) for x, y in zip(cuts, cuts[1:])]
    share = [max(1.0, min(p.most_weight, len(labels) / max(1, (labels == y).sum()) - 1)) for y in (0, 1)]

    del texts, hashes

    def weights(i):
        zi = z[i]
        w = -(zi - np.sign(zi) * p.l1) / ((p.beta + np.sqrt(n[i])) / p.alpha + p.l2)
        return np.where(np.abs(zi) <= p.l1, 0.0, w)

    for epoch in range(p.epochs):
        for k in np.random.default_rng(epoch).permutation(len(rows)).tolist():
            i = rows[k]
            w = weights(i)
            g = float(sigmoid(w.sum()) - labels[k]) * share[labels[k]]
            root = np.sqrt(n[i] + g * g)
            z[i] += g - (root - np.sqrt(n[i])) / p.alpha * w
            n[i] += g * g
    seen = np.flatnonzero(n)
    w = weights(seen)
    return seen[w != 0], w[w != 0]


def held_out(doc_id: Column) -> Column:
    return F.coalesce(F.pmod(F.crc32(doc_id.cast("string").cast("binary")), F.lit(3)) == 1, F.lit(False))


def training_rows(documents: DataFrame, labels: DataFrame, p: Ftrl) -> DataFrame:
    """(text, toxic) of the sample: labelled, not held out, the first rows of each label by a hash of doc_id.

    Rows with a null label or doc_id are left out; of repeated doc_ids in ``labels`` the highest label counts, and in
    ``documents`` the least text, so repeats don't widen the bound.
    """
    usable = (
        labels.where(F.col("toxic").isNotNull() & F.col("doc_id").isNotNull() & ~held_out(F.col("doc_id")))
        .groupBy("doc_id")
        .agg(F.max(F.col("toxic").cast("int")).alias("toxic"))
    )
    half = p.most_rows // 2
    chosen = [usable.where(F.col("toxic") == y).orderBy(F.xxhash64("doc_id"), "doc_id").limit(half) for y in (0, 1)]
    ids = chosen[0].unionByName(chosen[1])  # at most most_rows rows of two numbers: may be broadcast
    found = documents.select("doc_id", text_of("text").alias("text")).join(F.broadcast(ids), "doc_id")
    return found.groupBy("doc_id", "toxic").agg(F.min("text").alias("text")).select("doc_id", "text", "toxic")


def train(documents: DataFrame, labels: DataFrame, p: Ftrl = Ftrl()) -> DataFrame:
    """(coordinate, weight), 2^bits + 1 rows at most; no rows if nothing is labelled.

    The sample is small and bounded; it is written once, then dealt to as many shards as its rows, or its characters if
    texts are long, ask for.
    """
    sample = materialize(training_rows(documents, labels, p))
    rows, chars = sample.agg(F.count("*"), F.coalesce(F.sum(F.char_length("text")), F.lit(0))).first()
    shards = max(1, -(-rows // p.shard_rows), -(-chars // p.shard_chars))
    rows = sample.withColumn("shard", F.pmod(F.xxhash64(F.lit("shard"), "doc_id"), F.lit(shards)))

    def run(shard: pa.Table) -> pa.Table:
        shard = shard.sort_by([("doc_id", "ascending"), ("text", "ascending")])
        labels, texts = shard.column("toxic").to_numpy(), shard.column("text").to_pylist()
        del shard
        i, w = train_shard(texts, labels, p)
        return pa.table({"coordinate": i, "weight": w / shards})

    trained = rows.groupBy("shard").applyInArrow(run, "coordinate long, weight double")
    return trained.groupBy("coordinate").agg(F.sum("weight").alias("weight"))


def score(df: DataFrame, weights: DataFrame, p: Ftrl = Ftrl(), to: str = "score") -> DataFrame:
    """Add ``to``: the probability of label 1 by the text alone. Null and empty texts have the bias only.

    The weights that L1 leaves are gathered and broadcast: 2^bits + 1 pairs of numbers at most. Other columns stay, one
    named ``to`` is replaced; no shuffle. Texts of any length are scored whole, a very
    long one by itself; repeated rows get equal scores; an empty table gives no rows.
    """
    got = weights.toPandas()
    dense = np.zeros((1 << p.bits) + 1, np.float32)
    dense[got["coordinate"].to_numpy(np.int64)] = got["weight"].to_numpy()
    sent = df.sparkSession.sparkContext.broadcast((np.flatnonzero(dense).astype(np.int32), dense[dense != 0]))
    kept = [c for c in df.columns if c != to]
    own = free_name(df, "__text")
    plain = df.select(*(F.col(f"`{c}`") for c in kept), text_of("text").alias(own))

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        w = np.zeros((1 << p.bits) + 1, np.float32)
        i, v = sent.value
        w[i] = v
        hashes = WordHashes(p.stems)
        for batch in batches:
            for one in small(batch, own):
                texts = one.column(own).to_pylist()
                scores = np.concatenate([score_texts(texts[a:b], w, p, hashes) for a, b in chunks(texts)])
                yield pa.RecordBatch.from_arrays([*(one.column(c) for c in kept), pa.array(scores, pa.float64())], [*kept, to])

    return plain.mapInArrow(run, plain.drop(own).schema.add(to, "double"))


def score_texts(texts: list[str], w: np.ndarray, p: Ftrl, hashes: WordHashes) -> np.ndarray:
    doc, code = features(texts, p, hashes)
    heard = (w[:-1] != 0) | (w[twice(np.arange(1 << p.bits), p.bits)] != 0)
    hit = heard[code]
    pairs = once_and_twice(doc[hit] << p.bits | code[hit], p.bits)
    sums = np.bincount(pairs >> p.bits, w[pairs & ((1 << p.bits) - 1)].astype(np.float64), len(texts))
    return sigmoid(sums + float(w[1 << p.bits]))


def toxicity(documents: DataFrame, labels: DataFrame, p: Ftrl = Ftrl()) -> DataFrame:
    """doc_id, held_out, score, predicted for every row of ``documents`` (doc_id, text; other columns are ignored).

    Null and empty texts have the bias only, and without any label every score is 0.5. A null doc_id isn't held out.
    Repeated rows come back each; an empty table gives no rows; see training_rows for repeated and null labels."""
    scored = score(documents.select("doc_id", "text"), train(documents, labels, p), p)
    return scored.select(
        "doc_id", held_out(F.col("doc_id")).alias("held_out"), "score", (F.col("score") >= p.threshold).cast("int").alias("predicted")
    )
