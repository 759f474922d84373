"""Benchmark decontamination as a prefix-filtered set join.

An item's windows are its runs of ``width`` words; a window's tokens are its shingles of ``shingle`` words. Shingles are
ordered by how often all documents have them, rarest first. A document can hold ``need`` of a window's m shingles only if
it holds one of the m - need + 1 rarest, the window's prefix; with whole windows wanted, that is one shingle. Documents are
read twice, without a shuffle: once to count the items' shingles, once to find prefix shingles with the words around them.
Only these few places are joined to windows. A window's place follows from the shingle's; it has to lie within the document
(positional and length bounds), and then the words around the place are compared with the window's own.

What tells a pass which shingles matter is a bitmap over hashes with a bounded number of bits, the only thing broadcast; it
lets some others through, which the join drops.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from chainframe.llm import words as W
from chainframe.llm.bpe import small
from chainframe.llm.common import free_name, materialize, text_of

WIDTH, SHINGLE = 10, 5
#: Bits of the bitmap: at least BITS_A_HASH a hash, at most MOST_BITS (16 MB).
BITS_A_HASH, LEAST_BITS, MOST_BITS = 64, 1 << 20, 1 << 27
#: A common shingle's places are dealt to so many tasks.
SALTS = 16
#: Rows of an Arrow batch that a task gives back.
BATCH = 10_000


def _texts(df: DataFrame, key: str) -> DataFrame:
    """(key, th, __text): whole texts with a line break behind them, null as empty; th tells apart texts of one key."""
    return df.select(F.col(key).alias("key"), F.xxhash64(text_of("text")).alias("th"), F.concat(text_of("text"), F.lit("\n")).alias("__text"))


def _pieces(batches: Iterable[pa.RecordBatch]) -> Iterator[tuple[pa.RecordBatch, W.Words]]:
    for batch in batches:
        for one in small(batch, "__text", 1_000_000):
            yield one, W.words_of(one.column("__text"))


def _signed(hashes: np.ndarray) -> pa.Array:
    return pa.array(hashes.view(np.int64))


def item_windows(items: DataFrame, width: int = WIDTH, shingle: int = SHINGLE) -> DataFrame:
    """(key, window: its words joined by blanks, size: words of a shingle, hashes: of its shingles) per window of ``items``
    (item_id, text). An item of fewer words is one window; a window of fewer words than a shingle is one shingle."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for one, w in _pieces(batches):
            own = W.hashes(w)
            data = w.buf.tobytes()
            keys, texts, sizes, lists = [], [], [], []
            for row, (n, first) in enumerate(zip(w.counts.tolist(), w.first.tolist())):
                if not n:
                    continue
                size = min(shingle, n)
                part = W.Words(w.buf, w.start[first : first + n], w.end[first : first + n], w.row[first : first + n], w.counts, w.first)
                hashed = W.shingle_hashes(part, own[first : first + n], size)[1].view(np.int64)
                length = min(width, n)
                for k in range(n - length + 1):
                    keys.append(row)
                    texts.append(data[part.start[k] : part.end[k + length - 1]].decode())
                    sizes.append(size)
                    lists.append(hashed[k : k + length - size + 1])
            for a in range(0, len(keys), BATCH):
                cut = slice(a, a + BATCH)
                yield pa.RecordBatch.from_arrays(
                    [one.column("key").take(pa.array(keys[cut], pa.int64())), pa.array(texts[cut]), pa.array(sizes[cut], pa.int32()), pa.array(lists[cut], pa.list_(pa.int64()))],
                    ["key", "window", "size", "hashes"],
                )

    texts = _texts(items, "item_id")
    return texts.mapInArrow(run, texts.select("key").schema.add("window", "string").add("size", "integer").add("hashes", T.ArrayType(T.LongType())))


def bitmap(hashes: DataFrame) -> np.ndarray:
    """Bits set at two places for each of the distinct hashes in ``hashes`` (h). At most MOST_BITS / 64 numbers come here."""
    bits = LEAST_BITS
    wanted = BITS_A_HASH * hashes.count()
    while bits < min(wanted, MOST_BITS):
        bits *= 2
    places = F.explode(F.array(F.col("h").bitwiseAND(F.lit(bits - 1)), F.shiftrightunsigned("h", 32).bitwiseAND(F.lit(bits - 1))))
    words = hashes.select(places.alias("place")).groupBy(F.shiftright("place", 5).alias("word"))
    got = words.agg(F.bit_or(F.expr("shiftleft(1L, int(place & 31))")).alias("set")).toPandas()
    out = np.zeros(bits // 32, np.uint32)
    out[got["word"].to_numpy(np.int64)] = got["set"].to_numpy(np.int64).astype(np.uint32)
    return out.view(np.uint8)


def _seen(bits: np.ndarray, hashes: np.ndarray) -> np.ndarray:
    """Which of the hashes the bitmap lets through, as places."""
    most = np.uint64(len(bits) * 8 - 1)
    found = np.arange(len(hashes))
    for shift in (0, 32):
        place = (hashes[found] >> np.uint64(shift)) & most
        found = found[(bits[place >> np.uint64(3)] >> (place & np.uint64(7)).astype(np.uint8)) & 1 == 1]
    return found


def shingle_counts(docs: DataFrame, hashes: DataFrame, sizes: list[int]) -> DataFrame:
    """(h, n): how often all texts have each shingle of ``hashes`` (h), and some others; summed up by chunk first."""
    sent = docs.sparkSession.sparkContext.broadcast(bitmap(hashes))

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for _, w in _pieces(batches):
            own = W.hashes(w)
            for size in sizes:
                hashed = W.shingle_hashes(w, own, size)[1]
                found, n = np.unique(hashed[_seen(sent.value, hashed)], return_counts=True)
                yield pa.RecordBatch.from_arrays([_signed(found), pa.array(n)], ["h", "n"])

    return docs.mapInArrow(run, "h long, n long").groupBy("h").agg(F.sum("n").alias("n"))


def prefixes(windows: DataFrame, counts: DataFrame, containment: float = 1.0) -> DataFrame:
    """(window, need, m, size, h, at): of each window with m shingles, those m - need + 1 that documents have least often,
    at their places in the window; shingles that no document has find nothing and are left out."""
    own = windows.select("window", "size", F.size("hashes").alias("m"), F.posexplode("hashes").alias("at", "h"))
    ranked = own.join(counts, "h", "left").withColumn("n", F.coalesce("n", F.lit(0)))
    need = F.greatest(F.lit(1), F.ceil(F.col("m") * containment - 1e-9).cast("int"))
    order = Window.partitionBy("window").orderBy("n", "h", "at")  # a window has few shingles
    ranked = ranked.withColumn("need", need).withColumn("rank", F.row_number().over(order))
    return ranked.where("rank <= m - need + 1 AND n > 0").select("window", "need", "m", "size", "h", "at")


def places(docs: DataFrame, hashes: DataFrame, sizes: list[int], width: int = WIDTH) -> DataFrame:
    """Per text a row (key, th, n_words); per place of a shingle of ``hashes`` (h), and of some others, a row (key, th, h,
    at: its first word, before: words given before it, around: the words around it)."""
    sent = docs.sparkSession.sparkContext.broadcast(bitmap(hashes))
    names = ["key", "th", "n_words", "h", "at", "before", "around"]
    kinds = [pa.int64(), pa.int64(), pa.int64(), pa.int32(), pa.list_(pa.string())]

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for one, w in _pieces(batches):
            nothing = [pa.nulls(len(one), k) for k in kinds[1:]]
            yield pa.RecordBatch.from_arrays([one.column("key"), one.column("th"), pa.array(w.counts.astype(np.int64)), *nothing], names)
            own, data = W.hashes(w), None
            for size in sizes:
                first, hashed = W.shingle_hashes(w, own, size)
                found = _seen(sent.value, hashed)
                for a in range(0, len(found), BATCH):
                    data = data or w.buf.tobytes()
                    word, h = first[found[a : a + BATCH]], hashed[found[a : a + BATCH]]
                    row = w.row[word]
                    low = np.maximum(w.first[row], word - width + size)
                    high = np.minimum(w.first[row] + w.counts[row], word + width)
                    around = [data[x:y].decode().split(" ") for x, y in zip(w.start[low].tolist(), w.end[high - 1].tolist())]
                    at = pa.array(row)
                    yield pa.RecordBatch.from_arrays(
                        [one.column("key").take(at), one.column("th").take(at), pa.nulls(len(word), pa.int64()), _signed(h), pa.array(word - w.first[row]), pa.array((word - low).astype(np.int32)), pa.array(around, kinds[-1])],
                        names,
                    )

    schema = docs.drop("__text").schema.add("n_words", "long").add("h", "long").add("at", "long").add("before", "integer").add("around", T.ArrayType(T.StringType()))
    return docs.mapInArrow(run, schema)


def verified(found: DataFrame, prefix: DataFrame) -> DataFrame:
    """(key, th, window, at, length): where windows occur, each place once.

    A window begins as many words before a shingle as the shingle has before it in the window. It must lie within the
    text; all its words must be those around the place, or at least ``need`` of its shingles.
    """
    salted = prefix.withColumnRenamed("at", "offset").select("*", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))).alias("salt"))
    dealt = found.withColumn("salt", F.pmod(F.xxhash64("th", "at"), F.lit(SALTS)).cast("int"))
    met = dealt.join(salted, ["h", "salt"]).withColumn("words", F.split("window", " ")).withColumn("length", F.size("words"))
    met = met.withColumn("skip", F.col("before") - F.col("offset")).where("skip >= 0 AND size(around) - skip >= length")
    met = met.withColumn("here", F.slice("around", F.col("skip") + 1, F.col("length")))
    part = lambda words, k: F.slice(words, k + 1, F.col("size"))
    equal = F.filter(F.sequence(F.lit(0), F.col("m") - 1), lambda k: part(F.col("here"), k) == part(F.col("words"), k))
    met = met.where(F.when(F.col("need") == F.col("m"), F.col("here") == F.col("words")).otherwise(F.size(equal) >= F.col("need")))
    return met.select("key", "th", "window", (F.col("at") - F.col("offset")).alias("at"), F.col("length").cast("long").alias("length")).distinct()


def contamination(documents: DataFrame, items: DataFrame, width: int = WIDTH, shingle: int = SHINGLE, containment: float = 1.0) -> DataFrame:
    """``documents`` (doc_id, text, any other columns) with n_words, n_hit, n_items, hits and items.

    A window of an item (``items``: item_id, text) occurs where a document has all its words in its order, or with
    ``containment`` below 1 where that share of its shingles is at its place. hits: the words from start to before end of
    each stretch that occurrences cover, in order, words counted from 0; n_hit: words in them. items: ids as strings of items with occurring windows,
    sorted; n_items counts them. Null or empty texts, on either side, have no words and no windows. Repeated documents come
    back each, with equal results; repeated items count once by id; an item without an id hits words, but isn't counted or
    listed. Texts of any length are read whole. Columns of ``documents`` named like a new one are replaced. An empty table of
    documents gives no rows, one of items no hits.
    """
    new = ("n_words", "n_hit", "n_items", "hits", "items")
    documents = documents.drop(*new)
    docs = _texts(documents, "doc_id")
    windows = materialize(item_windows(items, width, shingle))
    distinct = materialize(windows.drop("key").dropDuplicates(["window"]))
    sizes = sorted(r["size"] for r in distinct.select("size").distinct().collect())  # numbers up to ``shingle``
    hashes = distinct.select(F.explode("hashes").alias("h")).distinct()
    prefix = materialize(prefixes(distinct, shingle_counts(docs, hashes, sizes), containment))
    found = materialize(places(docs, prefix.select("h").distinct(), sizes, width))
    occurring = materialize(verified(found.where("h IS NOT NULL").drop("n_words"), prefix))

    ends = occurring.groupBy("key", "th", "at").agg(F.max(F.col("at") + F.col("length")).alias("end"))
    per_doc = stretches(ends)
    named = windows.select(F.col("key").cast("string").alias("item"), "window").where("item IS NOT NULL").distinct()
    listed = occurring.select("key", "th", "window").distinct().join(named, "window").select("key", "th", "item").distinct()
    listed = listed.groupBy("key", "th").agg(F.array_sort(F.collect_list("item")).alias("items"))

    own_id, own_th, th = (free_name(documents, n) for n in ("__id", "__own", "__th"))
    sums = found.where("n_words IS NOT NULL").select("key", "th", "n_words").distinct()
    for side in (per_doc, listed):
        s = side.withColumnRenamed("key", "k2").withColumnRenamed("th", "t2")
        sums = sums.join(s, sums["key"].eqNullSafe(s["k2"]) & (sums["th"] == s["t2"]), "left").drop("k2", "t2")
    sums = sums.withColumnRenamed("key", own_id).withColumnRenamed("th", own_th)
    hashed = documents.withColumn(th, F.xxhash64(text_of("text")))
    joined = hashed.join(sums, hashed["doc_id"].eqNullSafe(sums[own_id]) & (hashed[th] == sums[own_th]), "left")
    hits = F.coalesce("hits", F.array().cast("array<struct<start:bigint,end:bigint>>"))
    own_items = F.coalesce("items", F.array().cast("array<string>"))
    return joined.select(
        *(joined[f"`{c}`"] for c in documents.columns), "n_words",
        F.aggregate(hits, F.lit(0).cast("long"), lambda n, s: n + s["end"] - s["start"]).alias("n_hit"),
        F.size(own_items).cast("long").alias("n_items"), hits.alias("hits"), own_items.alias("items"),
    )


def stretches(spans: DataFrame) -> DataFrame:
    """(key, th, hits) of spans (key, th, at, end) with one end for each place: those that touch or overlap as one. A text has
    at most as many as it has words."""
    order = Window.partitionBy("key", "th").orderBy("at")
    reach = F.max("end").over(order.rowsBetween(Window.unboundedPreceding, -1))
    own = spans.withColumn("apart", F.coalesce(F.col("at") > reach, F.lit(True)).cast("int")).withColumn("stretch", F.sum("apart").over(order))
    merged = own.groupBy("key", "th", "stretch").agg(F.min("at").alias("start"), F.max("end").alias("end"))
    return merged.groupBy("key", "th").agg(F.array_sort(F.collect_list(F.struct("start", "end"))).alias("hits"))


def contaminated(documents: DataFrame, items: DataFrame) -> DataFrame:
    """Per document: words, words hit, items found, the digest of their ids, and whether there is any hit."""
    found = contamination(documents.select("doc_id", "text"), items)
    return found.select(
        "doc_id", "n_words", "n_hit", "n_items", F.sha2(F.array_join("items", ",").cast("binary"), 256).alias("items_sha256"), (F.col("n_hit") > 0).alias("contaminated")
    )


#: Only where SQL is quick enough: it makes a row of each run of a document's words.
ORACLE_SQL = r"""
WITH d AS (
  SELECT row_number() OVER () AS row_id, doc_id,
         regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
  FROM documents),
i AS (
  SELECT item_id,
         regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
  FROM benchmark),
item_starts AS (
  SELECT item_id, w, least(len(w), 10) AS length, unnest(range(len(w) - least(len(w), 10) + 1)) AS p FROM i WHERE len(w) > 0),
windows AS (
  SELECT DISTINCT item_id, length, array_to_string(w[p + 1 : p + length], ' ') AS grams FROM item_starts),
lengths AS (SELECT DISTINCT length FROM windows),
doc_starts AS (
  SELECT row_id, w, length, unnest(range(len(w) - length + 1)) AS p FROM d JOIN lengths ON len(w) >= length),
occurring AS (
  SELECT s.row_id, s.p, s.length, s.grams
  FROM (SELECT row_id, p, length, array_to_string(w[p + 1 : p + length], ' ') AS grams FROM doc_starts) s
  WHERE grams IN (SELECT grams FROM windows)),
hit AS (
  SELECT row_id, count(DISTINCT word) AS n FROM (SELECT row_id, unnest(range(p, p + length)) AS word FROM occurring) GROUP BY row_id),
listed AS (
  SELECT row_id, count(*) AS n, string_agg(item, ',' ORDER BY item) AS items
  FROM (SELECT DISTINCT row_id, CAST(item_id AS VARCHAR) AS item FROM occurring JOIN windows USING (grams) WHERE item_id IS NOT NULL) GROUP BY row_id)
SELECT doc_id, len(w) AS n_words, coalesce(hit.n, 0) AS n_hit, coalesce(listed.n, 0) AS n_items,
       sha256(coalesce(items, '')) AS items_sha256, coalesce(hit.n, 0) > 0 AS contaminated
FROM d LEFT JOIN hit USING (row_id) LEFT JOIN listed USING (row_id)
"""
