"""Importance resampling towards a target distribution, over hashed word n-grams.

Both sides' n-grams are counted in buckets. A bucket's gain is the logarithm of how much more often the target has it; a
document's weight is the sum of its n-grams' gains; noise after Gumbel turns the highest scores into a sample without
replacement. Counting works on segments: texts are cut into lines, equal lines of the whole corpus are met once with the
number of their occurrences, and each distinct line's n-grams are counted once and multiplied; n-grams that cross a line
break are counted apart. Weights go the same way within a chunk of texts: distinct lines are weighed once.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from chainframe.llm import words as W
from chainframe.llm.bpe import small
from chainframe.llm.common import free_name, materialize, text_of


@dataclass(frozen=True)
class Resampling:
    """most_n: words of the longest n-gram; buckets; gains are rounded down to 1 / scale; percent of the documents with at
    least ``least_words`` words are drawn; seed is a prefix of what is hashed to noise."""

    most_n: int = 1
    buckets: int = 10_000
    scale: int = 1000
    least_words: int = 20
    percent: int = 10
    seed: str = "2024:"


def line_grams(lines: pa.Array, p: Resampling) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(line, bucket of each n-gram within it; words of each line)."""
    w = W.words_of(pc.binary_join_element_wise(lines, "\n", ""))
    rows, buckets = [], []
    for n in range(1, p.most_n + 1):
        a, b, _ = _grams(w, n)
        buckets.append(W.checksums(w.buf, w.start[a], w.end[b]) % p.buckets)
        rows.append(w.row[a])
    return np.concatenate(rows), np.concatenate(buckets), w.counts


def crossing_grams(texts: pa.Array, p: Resampling) -> tuple[np.ndarray, np.ndarray]:
    """(text, bucket) of each n-gram that crosses a line break."""
    broken = pc.list_flatten(parted := pc.split_pattern(texts, "\n"))
    w = W.words_of(pc.binary_join_element_wise(broken, "\n", ""))
    text = pc.list_parent_indices(parted).to_numpy(zero_copy_only=False)
    line, w.row = w.row, text[w.row]
    rows, buckets = [np.empty(0, np.int64)], [np.empty(0, np.uint32)]
    for n in range(2, p.most_n + 1):
        a, b, _ = _grams(w, n)
        across = line[a] != line[b]
        a, b = a[across], b[across]
        buckets.append(W.checksums(w.buf, w.start[a], w.end[b]) % p.buckets)
        rows.append(w.row[a])
    return np.concatenate(rows), np.concatenate(buckets)


def _grams(w: W.Words, n: int) -> tuple[np.ndarray, np.ndarray, int]:
    """First and last words of all n-grams within a row."""
    a = np.arange(max(0, len(w.start) - n + 1))
    a = a[w.row[a] == w.row[a + n - 1]]
    return a, a + n - 1, n


def bucket_counts(texts: DataFrame, p: Resampling) -> DataFrame:
    """(bucket, n) over all of ``texts`` (text): line by line, then across lines. Summed up by chunk before the shuffle."""
    lines = texts.select(F.explode(F.split(text_of("text"), "\n")).alias("text")).groupBy("text").agg(F.count("*").alias("times"))

    def summed(buckets: np.ndarray, times: np.ndarray) -> pa.RecordBatch:
        sums = np.zeros(p.buckets, np.int64)
        np.add.at(sums, buckets, times)
        own = np.flatnonzero(sums)
        return pa.RecordBatch.from_arrays([pa.array(own), pa.array(sums[own])], ["bucket", "n"])

    def within(one: pa.RecordBatch) -> pa.RecordBatch:
        line, bucket, _ = line_grams(one.column("text"), p)
        return summed(bucket, one.column("times").to_numpy()[line])

    def across(one: pa.RecordBatch) -> pa.RecordBatch:
        _, bucket = crossing_grams(one.column("text"), p)
        return summed(bucket, np.ones(len(bucket), np.int64))

    def each(f: Callable) -> Callable:
        def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                yield from map(f, small(batch, "text", 1_000_000))

        return run

    counted = lines.mapInArrow(each(within), "bucket long, n long")
    if p.most_n > 1:
        counted = counted.unionByName(texts.select(text_of("text").alias("text")).mapInArrow(each(across), "bucket long, n long"))
    return counted.groupBy("bucket").agg(F.sum("n").alias("n"))


def gains(raw: DataFrame, target: DataFrame, p: Resampling) -> DataFrame:
    """(bucket, gain) of all buckets, from both sides' counts: floor(scale * ln of the smoothed ratio of shares)."""
    s, t = raw.select("bucket", F.col("n").alias("s")), target.select("bucket", F.col("n").alias("t"))
    both = raw.sparkSession.range(p.buckets).withColumnRenamed("id", "bucket").join(s, "bucket", "left").join(t, "bucket", "left")
    both = both.fillna(0, ["s", "t"])
    sums = both.agg(F.sum("s").alias("all_s"), F.sum("t").alias("all_t")).first()
    up = (F.col("t") + 1).cast("double") * F.lit(float(sums["all_s"] + p.buckets))
    down = (F.col("s") + 1).cast("double") * F.lit(float(sums["all_t"] + p.buckets))
    return both.select("bucket", F.floor(p.scale * F.log(up / down)).cast("long").alias("gain"))


def weigh(docs: DataFrame, gained: DataFrame, p: Resampling) -> DataFrame:
    """``docs`` (text, any other columns) with n_words, n_features and weight, and without text. The gains, a number for each
    bucket, are broadcast."""
    got = gained.toPandas()  # p.buckets rows
    dense = np.zeros(p.buckets, np.int64)
    dense[got["bucket"].to_numpy(np.int64)] = got["gain"].to_numpy(np.int64)
    sent = docs.sparkSession.sparkContext.broadcast(dense)
    new = ("n_words", "n_features", "weight")
    kept = [c for c in docs.columns if c not in (*new, "text")]
    name = free_name(docs, "__text")
    plain = docs.select(*(F.col(f"`{c}`") for c in kept), text_of("text").alias(name))

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for one in small(batch, name, 1_000_000):
                texts = one.column(name)
                parted = pc.split_pattern(texts, "\n")
                text = pc.list_parent_indices(parted).to_numpy(zero_copy_only=False)
                met = pc.list_flatten(parted).dictionary_encode()
                which = met.indices.to_numpy(zero_copy_only=False)
                line, bucket, n_words = line_grams(met.dictionary, p)
                sums = [n_words, np.zeros(len(n_words), np.int64), np.zeros(len(n_words), np.int64)]  # of each distinct line
                np.add.at(sums[1], line, 1)
                np.add.at(sums[2], line, sent.value[bucket])
                out = [np.zeros(len(texts), np.int64) for _ in sums]
                for total, own in zip(out, sums):
                    np.add.at(total, text, own[which])
                if p.most_n > 1:
                    row, bucket = crossing_grams(texts, p)
                    np.add.at(out[1], row, 1)
                    np.add.at(out[2], row, sent.value[bucket])
                yield pa.RecordBatch.from_arrays([*(one.column(c) for c in kept), *map(pa.array, out)], [*kept, *new])

    schema = plain.drop(name).schema
    for column in new:
        schema = schema.add(column, "long")
    return plain.mapInArrow(run, schema)


def noise(seed: str) -> F.Column:
    """Gumbel noise of a row's doc_id in thousandths, rounded down; a null doc_id counts as an empty one."""
    digits = F.substring(F.sha2(F.concat(F.lit(seed), F.coalesce(F.col("doc_id").cast("string"), F.lit(""))).cast("binary"), 256), 1, 8)
    share = (F.conv(digits, 16, 10).cast("double") + 0.5) / 4294967296.0
    return F.floor(-1000 * F.log(-F.log(share))).cast("long")


def ranked(scored: DataFrame, p: Resampling) -> DataFrame:
    """Add rank (1, 2, 3...) to the drawn rows of ``scored`` (doc_id, n_words, score, th).

    Rows are range-partitioned in the order of ranks and sorted inside; a row's rank is its place in its partition behind
    the rows of the partitions before, so no task sees more than its share.
    """
    able = F.col("n_words") >= p.least_words
    order = [able.desc(), F.col("score").desc(), F.col("doc_id").asc_nulls_last(), "th"]
    placed = materialize(scored.repartitionByRange(*order).sortWithinPartitions(*order).withColumn("place", F.monotonically_increasing_id()))
    sizes = placed.groupBy(F.shiftright("place", 33).alias("part")).agg(F.count("*").alias("n"), F.count_if(able).alias("able")).toPandas()
    sizes = sizes.sort_values("part")  # a row for each partition
    drawn = int(sizes["able"].sum()) * p.percent // 100
    before = dict(zip(sizes["part"].tolist(), (sizes["n"].cumsum() - sizes["n"]).tolist()))
    offset = F.try_element_at(F.lit(None).cast("map<bigint,bigint>") if not before else F.create_map(*(F.lit(int(x)) for kv in before.items() for x in kv)), F.shiftright("place", 33))
    rank = (offset + F.col("place").bitwiseAND(F.lit((1 << 33) - 1)) + 1).cast("long")
    return placed.withColumn("rank", F.when(rank <= drawn, rank)).drop("place")


def resample(documents: DataFrame, target: DataFrame, p: Resampling = Resampling()) -> DataFrame:
    """Per row of ``documents`` (doc_id, text): doc_id, th (a hash of the text), n_words, n_features, weight, score and rank,
    null for rows that are not drawn.

    ``target`` (text) is what the sample should be like. A null or empty text has no words and weight 0. Ties in score go to
    the smaller doc_id, null last, then to the least hash of the text. Repeated rows are counted and ranked each. Texts of any
    length are read whole. An empty table gives no rows; without any target text gains are those of rare n-grams. Other columns are ignored.
    """
    docs = documents.select("doc_id", "text")
    found = gains(bucket_counts(docs, p), bucket_counts(target.select("text"), p), p)
    weighed = weigh(docs.withColumn("th", F.xxhash64(text_of("text"))), found, p)
    return ranked(weighed.withColumn("score", F.col("weight") + noise(p.seed)), p)


def importance_sample(documents: DataFrame, target: DataFrame) -> DataFrame:
    return resample(documents, target).select("doc_id", "n_features", "weight", "score", "rank")


#: CRC-32 goes over the bytes of each distinct word, with its table made by rule.
ORACLE_SQL = r"""
WITH steps AS (
  SELECT list(list_reduce(list_prepend(b, range(8)), lambda c, k: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END) ORDER BY b) AS crc
  FROM (SELECT unnest(range(256)) AS b)),
d AS (
  SELECT row_number() OVER () AS row_id, doc_id,
         regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
  FROM documents),
raw AS (SELECT row_id, unnest(w) AS word FROM d),
target AS (
  SELECT unnest(regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')) AS word
  FROM benchmark),
bytes AS (
  SELECT word, list_transform(range(octet_length(encode(word))), lambda k: CAST('0x' || hex(encode(word))[2 * k + 1 : 2 * k + 2] AS BIGINT)) AS b
  FROM (SELECT word FROM raw UNION SELECT word FROM target)),
hashed AS (
  SELECT word, xor(list_reduce(list_prepend(4294967295, b), lambda c, x: xor(crc[(xor(c, x) & 255) + 1], c >> 8)), 4294967295) % 10000 AS bucket
  FROM bytes, steps),
s AS (SELECT bucket, count(*) AS n FROM raw JOIN hashed USING (word) GROUP BY bucket),
t AS (SELECT bucket, count(*) AS n FROM target JOIN hashed USING (word) GROUP BY bucket),
sums AS (SELECT (SELECT coalesce(sum(n), 0) FROM s) AS all_s, (SELECT coalesce(sum(n), 0) FROM t) AS all_t),
gain AS (
  SELECT bucket, CAST(floor(1000 * ln(CAST((coalesce(t.n, 0) + 1) * (all_s + 10000) AS DOUBLE) / CAST((coalesce(s.n, 0) + 1) * (all_t + 10000) AS DOUBLE))) AS BIGINT) AS gain
  FROM (SELECT unnest(range(10000)) AS bucket) LEFT JOIN s USING (bucket) LEFT JOIN t USING (bucket), sums),
weights AS (
  SELECT row_id, sum(gain) AS weight FROM raw JOIN hashed USING (word) JOIN gain USING (bucket) GROUP BY row_id),
scored AS (
  SELECT row_id, doc_id, len(w) AS n_features, CAST(coalesce(weight, 0) AS BIGINT) AS weight,
         CAST(coalesce(weight, 0) + floor(-1000 * ln(-ln((CAST('0x' || sha256('2024:' || coalesce(CAST(doc_id AS VARCHAR), ''))[1:8] AS BIGINT) + 0.5::DOUBLE) / 4294967296))) AS BIGINT) AS score
  FROM d LEFT JOIN weights USING (row_id)),
placed AS (
  SELECT row_id, row_number() OVER (ORDER BY score DESC, doc_id NULLS LAST) AS place, count(*) OVER () AS able FROM scored WHERE n_features >= 20)
SELECT doc_id, n_features, weight, score, CASE WHEN place <= 10 * able // 100 THEN place END AS rank
FROM scored LEFT JOIN placed USING (row_id)
"""
