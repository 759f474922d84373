"""Quality rules from tokeniser fertility.

Public vocabularies measure each text, word by word: characters per token, the share of byte-fallback tokens and the
entropy of the tokens. Bands per language, or per script where the language has none, reject texts outside them. Words
are encoded once per worker and cached; rows are independent, so there is no shuffle.
"""

from __future__ import annotations

import functools
import itertools
from collections import Counter
from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from chainframe.llm.bpe import MergedSlices, merged_slices, small, vocabulary
from chainframe.llm.common import ASCII_SPACE, chunks, free_name, text_of

SYMBOLS = "#*$%&|<>"
WINDOW = 5


@dataclass(frozen=True)
class Band:
    """What a text may have: characters per token of the vocabulary with byte fallback and of the byte-level one, the
    share of fallback tokens, and the entropy relative to the largest possible one.

    Texts of any length are judged. The least characters per token are the usual ones less so many standard errors (see
    ``spread``), which widen as texts get shorter; and ``spare_fallback`` fallback tokens, two characters of four bytes,
    may be there beside the share."""

    chars: float
    chars_spread: float
    bpe_chars: float
    bpe_spread: float
    most_chars: float = 12.0
    most_fallback: float = 0.05
    least_entropy: float = 0.4
    spare_fallback: int = 8


#: Texts vary among themselves, however long they are, as much as parts of one text with so many tokens.
LONG = 2_000

#: Bands by language; texts of other languages go by script. Set from ``calibrate`` (medians, and 0.5th percentiles below
#: them, rounded up) over sf0.1: 998 en, 242 de, 146 es and 241 fr rows, 1,627 Latin ones.
BANDS = {
    "en": Band(2.219, 2.846, 2.292, 1.919),
    "de": Band(2.243, 3.073, 2.312, 1.984),
    "es": Band(1.940, 3.045, 2.221, 2.578),
    "fr": Band(1.978, 2.687, 2.073, 2.566),
}
#: No labelled row has another script than the Latin one, so "other" has no percentiles: it bars only extremes.
SCRIPT_BANDS = {"latin": Band(2.210, 9.385, 2.282, 7.497), "other": Band(0.3, 0.0, 0.3, 0.0, most_fallback=1.0, least_entropy=0.3)}


class Words(dict):
    """Word -> its number. Of each numbered word the arrays hold what both vocabularies make of it, so that texts are
    measured by look-ups in arrays: its pieces' ids in the vocabulary with byte fallback, how many of them are fallback,
    and how many tokens it has in the byte-level vocabulary.

    Words are encoded once, those of a chunk in one call a vocabulary. Beyond ``most`` words those go that were met once
    only, or are long; if others are still too many, all go. ``most_bytes`` bounds long words in the same way.
    """

    def __init__(self, model: bytes, merge: MergedSlices, most: int = 300_000, most_bytes: int = 16_000_000):
        super().__init__()
        import sentencepiece

        self.processor, self.merge, self.most, self.most_bytes, self.fresh = sentencepiece.SentencePieceProcessor(model_proto=model), merge, most, most_bytes, []
        n = self.processor.get_piece_size()
        self.is_byte = np.array([self.processor.is_byte(i) for i in range(n)])
        self.forget()

    def forget(self) -> None:
        self.clear()
        self.bytes = 0
        self.pieces, self.ends = np.empty(0, np.int32), np.zeros(1, np.int64)
        self.n_fallback, self.n_merged, self.met = (np.empty(0, np.int32) for _ in range(3))

    def __missing__(self, word: bytes) -> int:
        self[word] = n = len(self)
        self.bytes += len(word)
        self.fresh.append(word)
        return n

    def evict(self) -> None:
        words = list(self)
        often = np.array([i for i in np.flatnonzero(self.met > 1).tolist() if len(words[i]) <= 64], np.int64)
        if len(often) > self.most // 2:
            self.forget()
            return
        kept = [words[i] for i in often.tolist()]
        self.bytes = sum(map(len, kept))
        self.pieces, lengths = self.pieces_of(often)
        self.ends = np.concatenate([[0], np.cumsum(lengths)])
        self.n_fallback, self.n_merged, self.met = self.n_fallback[often], self.n_merged[often], np.zeros(len(often), np.int32)
        self.clear()
        self.update((w, i) for i, w in enumerate(kept))

    def numbers(self, words: list[bytes]) -> np.ndarray:
        if len(self) > self.most or self.bytes > self.most_bytes:
            self.evict()
        found = np.fromiter(map(self.__getitem__, words), np.int64, len(words))
        if self.fresh:
            self._learn(self.fresh)
            self.fresh = []
        self.met += np.bincount(found, minlength=len(self)).astype(np.int32)
        return found

    def _learn(self, fresh: list[bytes]) -> None:
        texts = [w.decode() for w in fresh]
        ids = self.processor.encode(texts, num_threads=1)
        lengths = np.fromiter(map(len, ids), np.int64, len(ids))
        flat = np.fromiter(itertools.chain.from_iterable(ids), np.int32, int(lengths.sum()))
        own = np.concatenate([[0], np.cumsum(lengths)])
        byte = np.concatenate([[0], np.cumsum(self.is_byte[flat])])
        self.n_fallback = np.append(self.n_fallback, (byte[own[1:]] - byte[own[:-1]]).astype(np.int32))
        self.n_merged = np.append(self.n_merged, self.merge.sizes(texts))
        self.met = np.append(self.met, np.zeros(len(fresh), np.int32))
        self.pieces, self.ends = np.append(self.pieces, flat), np.append(self.ends, own[1:] + self.ends[-1])

    def pieces_of(self, numbers: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(ids of all these words' pieces, one after another; how many each has)."""
        starts, lengths = self.ends[numbers], self.ends[numbers + 1] - self.ends[numbers]
        ends = np.cumsum(lengths)
        within = np.arange(ends[-1] if len(ends) else 0) - np.repeat(ends - lengths, lengths)
        return self.pieces[np.repeat(starts, lengths) + within], lengths


@functools.lru_cache(maxsize=2)
def words_of(model: bytes, ranks: bytes) -> Words:
    """One cache per pair of vocabularies and Python worker."""
    return Words(model, merged_slices(ranks)[0])


def entropy(ids: np.ndarray) -> float:
    """Bits per token over the largest possible number for so many tokens: 1 if all differ, 0 if all are equal."""
    if len(ids) < 2:
        return 0.0
    counts = np.unique(ids, return_counts=True)[1]
    p = counts / len(ids)
    return float(-(p * np.log2(p)).sum() / np.log2(len(ids)))


def repeated_words(words: np.ndarray, window: int = WINDOW) -> int:
    """Words, given as numbers, that lie in a window of ``window`` words which the text has twice or more."""
    n = len(words) - window + 1
    if n < 2:
        return 0
    mixed = np.zeros(n, np.uint64)
    for i in range(window):
        mixed = mixed * np.uint64(0x9E3779B97F4A7C15) + words[i : i + n].astype(np.uint64)
    if len(np.unique(mixed)) == n:  # equal windows are mixed to equal numbers
        return 0
    own = words.tolist()
    grams = list(zip(*(own[i:] for i in range(window))))
    counts = Counter(grams)
    covered = reach = 0
    for i, gram in enumerate(grams):
        if counts[gram] > 1:
            covered += i + window - max(i, reach)
            reach = i + window
    return covered


def repeated_lines(text: str) -> int:
    """Lines with a word that equal an earlier line."""
    lines = [x for x in text.split("\n") if x.strip(ASCII_SPACE)]
    return len(lines) - len(set(lines))


@functools.cache
def letters() -> np.ndarray:
    """Of each code point: 1 for letters of the Latin blocks, 2 for other letters, 0 else."""
    table = np.zeros(0x110000, np.uint8)
    for code in range(0x110000):
        if chr(code).isalpha():
            table[code] = 1 if code < 0x250 else 2
    return table


def script_of(text: str) -> str:
    """latin, unless most letters lie beyond the Latin blocks."""
    if text.isascii():
        return "latin"
    n = np.bincount(letters()[np.frombuffer(text.encode("utf-32-le"), np.uint32)], minlength=3)
    return "other" if n[2] > n[1] else "latin"


SCHEMA = [
    ("n_words", pa.int64()), ("word_chars", pa.int64()), ("n_symbols", pa.int64()), ("n_dup_lines", pa.int64()), ("n_repeat_words", pa.int64()),
    ("n_tokens", pa.int64()), ("chars_per_token", pa.float64()), ("fallback_share", pa.float64()), ("token_entropy", pa.float64()), ("bpe_chars_per_token", pa.float64()), ("script", pa.string()),
]


def measure(df: DataFrame, pieces_path: str, ranks_path: str, text: str = "text") -> DataFrame:
    """``df`` without its text, with the columns of SCHEMA.

    Words are ``[^\\x20\\x09-\\x0D]+``; null and empty texts have none, and shares of nothing are 0. Repeated rows give
    repeated results, an empty table none; nothing is compared between rows, so there are no ties. Texts of any length are
    measured whole; a very long one is held in memory by itself. Columns of ``df`` that clash with new ones are replaced.
    """
    pieces, ranks = vocabulary(df, pieces_path), vocabulary(df, ranks_path)
    names = [n for n, _ in SCHEMA]
    kept = [c for c in df.columns if c not in (text, *names)]
    own = free_name(df, "__text")
    plain = df.select(*(F.col(f"`{c}`") for c in kept), text_of(text).alias(own))
    schema = plain.drop(own).schema
    for n, t in SCHEMA:
        schema = schema.add(n, "long" if t == pa.int64() else "double" if t == pa.float64() else "string")

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = words_of(pieces.value, ranks.value)
        for batch in batches:
            for one in small(batch, own):
                texts = one.column(own).to_pylist()
                rows = [r for a, b in chunks(texts) for r in measure_texts(texts[a:b], words)]
                new = [pa.array(c, t) for c, (_, t) in zip(zip(*rows), SCHEMA)]
                yield pa.RecordBatch.from_arrays([*(one.column(c) for c in kept), *new], [*kept, *names])

    return plain.mapInArrow(run, schema)


def measure_texts(texts: list[str], words: Words) -> Iterator[tuple]:
    split = [t.encode().split() for t in texts]  # bytes.split: exactly the ASCII white space of the word rule
    numbers = words.numbers([w for own in split for w in own])
    ids, lengths = words.pieces_of(numbers)
    sums = [np.concatenate([[0], np.cumsum(x)]) for x in (lengths, words.n_fallback[numbers], words.n_merged[numbers])]
    ends = np.cumsum([len(own) for own in split]).tolist()
    for text, a, b in zip(texts, [0, *ends], ends):
        (n_from, n_to), fallback, bpe = sums[0][[a, b]].tolist(), int(sums[1][b] - sums[1][a]), int(sums[2][b] - sums[2][a])
        n, chars = n_to - n_from, len(text) - sum(map(text.count, ASCII_SPACE))
        yield (
            b - a, chars, sum(map(text.count, SYMBOLS)), repeated_lines(text), repeated_words(numbers[a:b]),
            n, chars / n if n else 0.0, fallback / n if n else 0.0, entropy(ids[n_from:n_to]), chars / bpe if bpe else 0.0, script_of(text),
        )


def within(bands: dict[str, Band], scripts: dict[str, Band]):
    """The verdict as a column over measured rows; null or unknown languages go by script."""

    def rule(b: Band):
        first = F.col("chars_per_token").between(b.chars - b.chars_spread * spread(), F.lit(b.most_chars))
        second = F.col("bpe_chars_per_token").between(b.bpe_chars - b.bpe_spread * spread(), F.lit(b.most_chars))
        n = F.col("n_tokens")
        return first & second & (F.col("fallback_share") * n <= b.most_fallback * n + b.spare_fallback) & (F.col("token_entropy") >= b.least_entropy)

    by_script = F.when(F.col("script") == "latin", rule(scripts["latin"])).otherwise(rule(scripts["other"]))
    verdict = by_script
    for lang, band in bands.items():
        verdict = F.when(F.coalesce(F.col("lang"), F.lit("")) == lang, rule(band)).otherwise(verdict)
    return verdict


def spread() -> Column:
    """The standard error that characters per token of a text have, in those of one token."""
    return F.sqrt(1 / F.greatest(F.col("n_tokens"), F.lit(1)) + F.lit(1 / LONG))


def calibrate(rated: DataFrame, labels: DataFrame, low: float = 0.005, most: int = 5_000) -> DataFrame:
    """(name, chars, chars_spread, bpe_chars, bpe_spread, n): Band's values by language and, in capitals, by script, so
    that a share ``low`` of clean rows lies below each least value.

    The sample is the half of the doc_ids with an even hash, so that the other half can measure what the bands do; at
    most ``most`` rows a name, those with the least hashes.
    """
    clean = labels.where("quality = 1").select("doc_id").distinct()
    judged = rated.where((F.pmod(F.xxhash64("doc_id"), F.lit(2)) == 0) & ~F.col("base_failed"))
    one = judged.join(clean, "doc_id", "left_semi").select("doc_id", "n_tokens", "chars_per_token", "bpe_chars_per_token", F.explode(F.array("lang", F.upper("script"))).alias("name"))
    of = Window.partitionBy("name")
    sample = one.where("name IS NOT NULL").withColumn("__n", F.row_number().over(of.orderBy(F.xxhash64("doc_id")))).where(F.col("__n") <= most)
    for c, m in (("chars_per_token", "chars"), ("bpe_chars_per_token", "bpe_chars")):
        sample = sample.withColumn(m, F.percentile(c, F.lit(0.5)).over(of)).withColumn(f"__{m}", (F.col(m) - F.col(c)) / spread())
    return sample.groupBy("name").agg(
        F.first("chars").alias("chars"), F.percentile("__chars", F.lit(1 - low)).alias("chars_spread"),
        F.first("bpe_chars").alias("bpe_chars"), F.percentile("__bpe_chars", F.lit(1 - low)).alias("bpe_spread"), F.count("*").alias("n"),
    )


def rate(df: DataFrame, pieces_path: str, ranks_path: str, bands: dict[str, Band] = BANDS, scripts: dict[str, Band] = SCRIPT_BANDS) -> DataFrame:
    """``df`` (text, lang, other columns) measured, with base_failed and kept.

    base_failed: under 10 words, or over a fifth of them in repeated windows. kept: not base_failed and inside the band.
    """
    base_failed = (F.col("n_words") < 10) | (100 * F.col("n_repeat_words") > 20 * F.col("n_words"))
    rated = measure(df.drop("base_failed", "kept"), pieces_path, ranks_path).withColumn("base_failed", base_failed)
    return rated.withColumn("kept", ~F.col("base_failed") & within(bands, scripts))


def quality(documents: DataFrame, pieces_path: str, ranks_path: str) -> DataFrame:
    return rate(documents.select("doc_id", "text", "lang"), pieces_path, ranks_path).drop("lang")
