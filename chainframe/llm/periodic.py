"""Periodic run detection by recursive frequency splitting.

Every word of a run of period q that is at least ``exponent`` periods long occurs ``exponent`` times in the run, so words
that are rarer than that within a segment belong to no run of it and split it. The pieces are counted anew and split again
until nothing changes: of prose little survives. What survives of many texts is laid out in one array and scanned lag by
lag: lags come in octaves, blocks of a quarter of an octave's least lag are compared with the blocks a lag further on, and
only chains of equal blocks that are long enough for a run are extended word by word. Pieces of runs that a smaller octave
has found are passed over, so a scan costs n log n steps whatever the text.
"""

from __future__ import annotations

from bisect import bisect_left
from collections import Counter, defaultdict
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from chainframe.llm.bpe import small
from chainframe.llm.common import free_name, text_of

#: A run has at least EXPONENT periods and LEAST words.
EXPONENT, LEAST = 4, 6
RUN = T.StructType().add("start", "long").add("length", "long").add("period", "long")
_ODD = (np.uint64(0x9E3779B97F4A7C15), np.uint64(0xC2B2AE3D27D4EB4F))


def surviving(words: list[bytes], exponent: int = EXPONENT, least: int = LEAST) -> list[tuple[int, int]]:
    """Segments [lo, hi) of at least ``least`` words in which each word occurs at least ``exponent`` times, and outside of
    which no run lies.

    A segment that splits hands its counts on to its largest piece, less what lies outside of that, where this is the
    smaller part; the other pieces are counted. So a word is counted some log n times, however often segments split.
    """
    done: list[tuple[int, int]] = []
    where: dict[bytes, list[int]] = {}
    open_ = [(0, len(words), Counter(words), None)] if len(words) >= least else []
    while open_:
        lo, hi, counts, few = open_.pop()
        if few is None:
            cuts = [i for i, w in enumerate(words[lo:hi], lo) if counts[w] < exponent]
        else:
            if not where:
                where = defaultdict(list)
                for i, w in enumerate(words):
                    where[w].append(i)
            cuts = sorted(i for w in few for i in where[w][bisect_left(where[w], lo) : bisect_left(where[w], hi)])
        if not cuts:
            done.append((lo, hi))
            continue
        pieces = [(a, b) for a, b in zip([lo, *(c + 1 for c in cuts)], [*cuts, hi]) if b - a >= least]
        if not pieces:
            continue
        a, b = largest = max(pieces, key=lambda p: p[1] - p[0])
        for piece in pieces:
            if piece is not largest:
                open_.append((*piece, Counter(words[slice(*piece)]), None))
        if hi - lo < 2 * (b - a):
            few = set()
            for w, n in Counter(words[lo:a] + words[b:hi]).items():
                counts[w] -= n
                if counts[w] < exponent:
                    few.add(w)
            open_.append((a, b, counts, few))
        else:
            open_.append((a, b, Counter(words[a:b]), None))
    return done


def lag_scan(x: np.ndarray, longest: int, exponent: int = EXPONENT, least: int = LEAST) -> list[tuple[int, int, int]]:
    """(start, length, period) of the runs in ``x``, numbers of words from 0; what may lie in no run is negative and unlike
    all else. ``longest``: the most words between two such."""
    if longest < least:
        return []
    n, most = len(x), longest // exponent
    x = np.concatenate([x, -np.arange(2, 2 * longest + 4) - n])  # no lag reaches beyond the end
    hashes, width = x.view(np.uint64), 1
    end, period = np.zeros(n, np.int64), np.ones(n, np.int64)  # of the run that reaches furthest from each word
    found: list[tuple[int, int, int]] = []
    s = 1
    while s <= most:
        b = max(1, s // 4)
        if b > width:
            hashes = hashes[:-width] * _ODD[0] + (hashes[width:] ^ (hashes[width:] >> np.uint64(29))) * _ODD[1]
            width = b
        lags = min(2 * s - 1, most) - s + 1
        later = np.lib.stride_tricks.sliding_window_view(hashes[s:], lags)[:n:b]
        k, q = np.nonzero(later == hashes[:n:b][: len(later), None])
        q += s
        at = k * b
        fresh = (end[at] < at + q + b) | (q % period[at] != 0)
        k, q = k[fresh], q[fresh]
        order = np.lexsort((k, q))
        k, q = k[order], q[order]
        starts = np.flatnonzero(np.r_[True, (np.diff(k) != 1) | (np.diff(q) != 0)][: len(k)])
        lengths = np.diff(np.r_[starts, len(k)])
        need = np.maximum((exponent - 1) * q[starts], least - q[starts])  # words equal to the word a lag further on
        long_enough = lengths >= np.maximum(1, (need - b + 1) // b)
        new = set()
        for i, m, w in zip(starts[long_enough].tolist(), lengths[long_enough].tolist(), need[long_enough].tolist()):
            lag, lo = int(q[i]), int(k[i]) * b
            hi = lo + m * b
            if b > 1 and not np.array_equal(x[lo:hi], x[lo + lag : hi + lag]):
                continue
            lo, hi = _extended(x, lo, hi, lag, b)
            if hi - lo >= w and end[lo] < hi + lag:
                new.add((lo, hi + lag - lo, lag))
        for lo, m, lag in new:
            reach = slice(lo, lo + m)
            further = end[reach] < lo + m
            period[reach][further] = lag
            end[reach][further] = lo + m
        found += new
        s *= 2
    return found


def _extended(x: np.ndarray, lo: int, hi: int, lag: int, step: int) -> tuple[int, int]:
    """The widest [lo, hi) around the given one whose words are equal to the words a lag further on."""
    while lo > 0:
        c = min(step, lo)
        same = (x[lo - c : lo] == x[lo - c + lag : lo + lag])[::-1]
        if not same.all():
            lo -= int(same.argmin())
            break
        lo -= c
    while not (differ := x[hi : hi + step] != x[hi + lag : hi + lag + step]).any():
        hi += step
    return lo, hi + int(differ.argmax())


def runs_of(texts: list[list[bytes]], exponent: int = EXPONENT, least: int = LEAST) -> list[list[tuple[int, int, int]]]:
    """Each text's runs (start, length, period) by start, then period."""
    numbers: dict[bytes, int] = {}
    parts: list[np.ndarray] = []
    places: list[tuple[int, int, int]] = []  # where a segment begins in the array; its text; its first word
    size = longest = 0
    for t, words in enumerate(texts):
        for lo, hi in surviving(words, exponent, least):
            places.append((size, t, lo))
            parts += [np.fromiter((numbers.setdefault(w, len(numbers)) for w in words[lo:hi]), np.int64, hi - lo), np.array([-1 - size])]
            size += hi - lo + 1
            longest = max(longest, hi - lo)
    out: list[list[tuple[int, int, int]]] = [[] for _ in texts]
    if places:
        begins = [p[0] for p in places]
        for start, length, period in lag_scan(np.concatenate(parts), longest, exponent, least):
            begin, t, lo = places[bisect_left(begins, start + 1) - 1]
            out[t].append((start - begin + lo, length, period))
    return [sorted(r, key=lambda r: (r[0], r[2])) for r in out]


def collapsed(words: list[bytes], runs: list[tuple[int, int, int]]) -> bytes:
    """The words joined by blanks, without those that some run contains after its first period."""
    dropped = bytearray(len(words))
    for start, length, period in runs:
        dropped[start + period : start + length] = b"\1" * (length - period)
    return b" ".join(w for w, d in zip(words, dropped) if not d)


def find_runs(df: DataFrame, exponent: int = EXPONENT, least: int = LEAST) -> DataFrame:
    """``df`` (text, any other columns) with n_words, runs (by start, then period) and collapsed.

    Words are maximal stretches without ASCII white space, numbered from 0. A run is a stretch of words of smallest period q
    with at least max(least, exponent * q) words that no neighbouring word extends; runs may overlap. collapsed: the words
    that no run repeats, joined by blanks. A null or empty text, or one of white space, has no words, no runs and an empty
    collapsed text. Texts of any length are scanned whole, a very long one by itself. Rows depend on their own text alone, so
    repeated rows and null ids don't matter. Columns of ``df`` named like a new one are replaced. An empty table gives no
    rows.
    """
    new = ("n_words", "runs", "collapsed")
    kept = [c for c in df.columns if c not in new]
    name = free_name(df, "__text")
    plain = df.select(*(F.col(f"`{c}`") for c in kept), text_of("text").alias(name))
    struct = pa.list_(pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())]))

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for one in small(batch, name, 1_000_000):
                texts = [t.encode().split() for t in one.column(name).to_pylist()]
                runs = runs_of(texts, exponent, least)
                made = [
                    pa.array([len(t) for t in texts], pa.int64()),
                    pa.array([[dict(zip(("start", "length", "period"), r)) for r in own] for own in runs], struct),
                    pa.array([collapsed(t, own).decode() for t, own in zip(texts, runs)], pa.string()),
                ]
                yield pa.RecordBatch.from_arrays([*(one.column(c) for c in kept), *made], [*kept, *new])

    return plain.mapInArrow(run, plain.drop(name).schema.add("n_words", "long").add("runs", T.ArrayType(RUN)).add("collapsed", "string"))


def strongest(runs: Column) -> Column:
    """Of runs by start, then period, the first one with the most periods, exactly; null without runs."""
    more = lambda best, r: F.when(best.isNull() | (r["length"] * best["period"] > best["length"] * r["period"]), r).otherwise(best)
    return F.aggregate(runs, F.lit(None).cast(RUN), more)


def repeat_tails(documents: DataFrame) -> DataFrame:
    """doc_id and text, where each tenth document by its id's hash h ends in repeats of some of its words: with n words and
    g = h div 10, word i from a = g % n on becomes word a + (i - a) % p, p = 1 + (n - a) div (3 + g % 8)."""
    h = F.crc32(F.col("doc_id").cast("string").cast("binary"))
    words = F.filter(F.split(text_of("text"), r"[\x20\x09-\x0D]+"), lambda w: w != "")
    cut = documents.select("doc_id", "text", (h / 10).cast("long").alias("g"), F.when(h % 10 == 0, words).alias("words"))
    placed = cut.withColumn("n", F.size("words")).withColumn("a", F.when(F.col("n") > 0, F.col("g") % F.col("n")))
    placed = placed.withColumn("p", F.expr("1 + (n - a) div (3 + g % 8)"))
    text = F.expr("array_join(concat(slice(words, 1, int(a)), slice(flatten(array_repeat(slice(words, int(a + 1), int(p)), int((n - a) div p + 1))), 1, int(n - a))), ' ')")
    return placed.select("doc_id", F.when(F.col("a").isNotNull(), text).otherwise(F.col("text")).alias("text"))


def run_digests(documents: DataFrame) -> DataFrame:
    """Per document: how many runs there are, the strongest one, and digests of all runs and of the collapsed text."""
    found = find_runs(repeat_tails(documents)).withColumn("best", strongest(F.col("runs")))
    lines = F.transform("runs", lambda r: F.concat_ws(",", *(r[c].cast("string") for c in ("start", "length", "period"))))
    listed = F.concat(F.array_join(lines, "\n"), F.when(F.size("runs") > 0, "\n").otherwise(""))
    return found.select(
        "doc_id", "n_words", F.size("runs").cast("long").alias("n_runs"), "best.start", "best.length", "best.period",
        F.expr("1000 * best.length div best.period").alias("exponent_milli"),
        F.sha2(listed.cast("binary"), 256).alias("runs_sha256"), F.sha2(F.col("collapsed").cast("binary"), 256).alias("collapsed_sha256"),
    )
