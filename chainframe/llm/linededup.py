"""Line dedup with DataFrame functions only.

Lines' keys are hashed to 128 bits. The hashes are range-partitioned and sorted by document and position inside; windows
stream over them and mark each key's first occurrence and how many documents have it. A key that holds more than a
thousandth of all lines is dealt out over slices of documents first. What comes back per document is a compressed keep
bitmap: 64-bit words in which a set bit is a dropped line, words without any left out. Texts meet their bitmaps once.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from chainframe.llm.common import ASCII_SPACE, free_name, materialize, text_of

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
#: A key with over 1 / HEAVY of all lines is sliced, so at most HEAVY keys are, which bounds what is broadcast.
HEAVY, SLICES = 1024, 64


def ascii_lower(text: Column) -> Column:
    """A-Z in lower case, other characters as they are. lower() is faster and the same on pure ASCII."""
    return F.when(F.octet_length(text) == F.char_length(text), F.lower(text)).otherwise(F.translate(text, UPPER, LOWER))


def line_key(line: Column) -> Column:
    """The line without ASCII white space at both ends, A-Z in lower case."""
    return ascii_lower(F.btrim(line, F.lit(ASCII_SPACE)))


def document_key(df: DataFrame) -> DataFrame:
    """doc_id, th (hash of the text) and lines; the two name a document even if a doc_id is null or repeated."""
    text = text_of("text")
    return df.select("doc_id", F.xxhash64(text).alias("th"), F.split(text, "\n").alias("lines"))


def line_hashes(df: DataFrame, min_chars: int = 1) -> DataFrame:
    """(doc_id, th, pos, h1, h2): the lines whose keys have at least ``min_chars`` code points."""
    exploded = document_key(df).select("doc_id", "th", F.posexplode("lines").alias("pos", "line"))
    keyed = exploded.select("doc_id", "th", "pos", line_key(F.col("line")).alias("key"))
    return keyed.where(F.char_length("key") >= min_chars).select(
        "doc_id", "th", "pos", F.xxhash64("key").alias("h1"), F.xxhash64(F.lit("line"), "key").alias("h2")
    )


def mark_lines(lines: DataFrame) -> DataFrame:
    """Add n_docs (documents that have the key) and first (whether this line is the key's first) to hashed lines.

    A document is a distinct doc_id, null being one of its own. ``lines`` should be a materialised table: it is read
    thrice.
    """
    least = F.lit(max(1, lines.count() // HEAVY))
    own = lines.groupBy("h1", "h2").agg(F.count("*").alias("n")).where(F.col("n") > least).select("h1", "h2")
    heavy = (
        lines.join(F.broadcast(own), ["h1", "h2"])
        .groupBy("h1", "h2", "doc_id")
        .agg(F.min("pos").alias("pos"))
        .groupBy("h1", "h2")
        .agg(F.count("*").alias("heavy_docs"), F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "pos")).alias("heavy_first"))
    )
    sliced = lines.join(F.broadcast(heavy), ["h1", "h2"], "left").withColumn(
        "slice", F.when(F.col("heavy_docs").isNotNull(), F.pmod(F.xxhash64("doc_id"), F.lit(SLICES))).otherwise(F.lit(0))
    )
    dealt = sliced.repartitionByRange("h1", "h2", "slice")
    group = Window.partitionBy("h1", "h2", "slice")
    order = group.orderBy(F.col("doc_id").asc_nulls_last(), "pos")
    streamed = (
        dealt.withColumn("rank", F.row_number().over(order))
        .withColumn("new_doc", (F.col("rank") == 1) | ~F.col("doc_id").eqNullSafe(F.lag("doc_id").over(order)))
        .withColumn("docs_here", F.count_if("new_doc").over(group))
    )
    first = F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "pos").eqNullSafe(F.col("heavy_first"))
    return streamed.select(
        "doc_id", "th", "pos", "h1", "h2",
        F.coalesce("heavy_docs", "docs_here").alias("n_docs"),
        F.when(F.col("heavy_docs").isNull(), F.col("rank") == 1).otherwise(first).alias("first"),
    )


def keep_bitmaps(marked: DataFrame, drop: Column) -> DataFrame:
    """(doc_id, th, dropped: map of word number -> 64 bits): the lines for which ``drop`` holds."""
    words = (
        marked.where(drop)
        .groupBy("doc_id", "th", F.expr("pos div 64").cast("int").alias("word"))
        .agg(F.bit_or(F.expr("shiftleft(1L, pos % 64)")).alias("bits"))
    )
    return words.groupBy("doc_id", "th").agg(F.map_from_entries(F.collect_list(F.struct("word", "bits"))).alias("dropped"))


def apply_bitmaps(df: DataFrame, bitmaps: DataFrame) -> DataFrame:
    """Each document with n_lines, n_dropped and kept (its other lines joined by \\n)."""
    th, own_id, own_th, bits = (free_name(df, n) for n in ("__th", "__id", "__bth", "__dropped"))
    split = df.select(*(F.col(f"`{c}`") for c in df.columns), F.xxhash64(text_of("text")).alias(th))
    b = bitmaps.select(F.col("doc_id").alias(own_id), F.col("th").alias(own_th), F.col("dropped").alias(bits))
    joined = split.join(b, split["doc_id"].eqNullSafe(b[own_id]) & (split[th] == b[own_th]), "left")
    lines = F.split(text_of("text"), "\n")

    def stays(_: Column, i: Column) -> Column:
        word = F.coalesce(F.try_element_at(bits, F.floor(i / F.lit(64)).cast("int")), F.lit(0).cast("long"))
        return F.call_function("bit_get", word, i % F.lit(64)) == 0

    n_dropped = F.aggregate(F.map_values(bits), F.lit(0).cast("long"), lambda a, w: a + F.bit_count(w))
    text = F.when(F.col(bits).isNull(), text_of("text")).otherwise(F.array_join(F.filter(lines, stays), "\n"))
    return joined.select(
        *(F.col(f"`{c}`") for c in df.columns),
        F.size(lines).cast("long").alias("n_lines"),
        F.coalesce(n_dropped, F.lit(0).cast("long")).alias("n_dropped"),
        text.alias("kept"),
    )


def dedup_lines(df: DataFrame, min_chars: int = 1, min_docs: int = 10, keep_first: bool = False) -> DataFrame:
    """``df`` (doc_id, text, any other columns) with n_lines, n_dropped and kept.

    Keys of at least ``min_chars`` code points that at least ``min_docs`` documents have lose their lines: all of them,
    or with ``keep_first`` all but the first by doc_id and position. A document is a distinct doc_id; null is one, and
    sorts last. A null or empty text is one empty line, which has no key and stays. Repeated rows lose the same lines
    each. Columns of ``df`` named like a new one are replaced. An empty table gives no rows.
    """
    df = df.drop("n_lines", "n_dropped", "kept")
    marked = mark_lines(materialize(line_hashes(df.select("doc_id", "text"), min_chars)))
    drop = F.col("n_docs") >= min_docs
    return apply_bitmaps(df, keep_bitmaps(marked, drop & ~F.col("first") if keep_first else drop))


def line_digests(documents: DataFrame, min_docs: int = 10) -> DataFrame:
    """Per document: n_lines, n_dropped and the SHA-256 of what stays."""
    done = dedup_lines(documents.select("doc_id", "text"), min_docs=min_docs)
    return done.select("doc_id", "n_lines", "n_dropped", F.sha2(F.col("kept").cast("binary"), 256).alias("kept_sha256"))


ORACLE_SQL = r"""
WITH lines AS (
  SELECT doc_id, unnest(string_split(coalesce(text, ''), chr(10))) AS line,
         generate_subscripts(string_split(coalesce(text, ''), chr(10)), 1) AS pos
  FROM documents),
keyed AS (
  SELECT doc_id, pos, line,
         translate(trim(line, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)),
                   'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS key
  FROM lines),
common AS (
  SELECT key FROM keyed WHERE length(key) >= 1 GROUP BY key HAVING count(DISTINCT doc_id) >= 10)
SELECT doc_id, count(*) AS n_lines, count(common.key) AS n_dropped,
       sha256(coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (WHERE common.key IS NULL), '')) AS kept_sha256
FROM keyed LEFT JOIN common ON keyed.key = common.key
GROUP BY doc_id
"""
