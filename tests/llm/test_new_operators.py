"""Periodic runs, decontamination and resampling against brute force, and on awkward tables."""

import collections
import hashlib
import math
import random
import re
import zlib

import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from chainframe.llm import decontamination, periodic, queries, resampling
from chainframe.llm import words as W

from test_llm import AWKWARD, DOCUMENTS, SF_DIR, WORD, sha

TERM = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def lower(text):
    return (text or "").translate({i: i + 32 for i in range(65, 91)})


def terms(text):
    return TERM.findall(lower(text))


@pytest.fixture(scope="module")
def docs(spark):
    clash = {"runs": F.lit(1), "collapsed": F.lit("x"), "hits": F.lit(0), "items": F.lit("?"), "n_words": F.lit("?"), "n_hit": F.lit(0), "weight": F.lit("?"), "score": F.lit("s"), "rank": F.lit("r"), "th": F.lit("?"), "key": F.lit(0), "__text": F.lit("?"), "__th": F.lit(0), "__id": F.lit("?"), "__own": F.lit(1)}
    return spark.createDataFrame(AWKWARD, DOCUMENTS).withColumns(clash)


@pytest.fixture(scope="module")
def empty(docs):
    return docs.limit(0)


@pytest.fixture(scope="module")
def texts(spark):
    return {r.doc_id: r.text or "" for r in spark.read.parquet(f"{SF_DIR}/documents.parquet").select("doc_id", "text").collect()}


@pytest.fixture(scope="module")
def items(spark):
    return [(r.item_id, r.text) for r in spark.read.parquet(f"{SF_DIR}/benchmark.parquet").select("item_id", "text").collect()]


# --- 11 -----------------------------------------------------------------------------------------------------------


def brute_runs(words, exponent=4, least=6):
    """Every stretch of every period, extended word by word; its period is the smallest if none below fits."""
    n, out = len(words), []
    for q in range(1, n // exponent + 1):
        i = 0
        while i + q < n:
            j = i
            while j + q < n and words[j] == words[j + q]:
                j += 1
            length = j + q - i
            if j > i and length >= max(least, exponent * q) and not any(all(words[t] == words[t + d] for t in range(i, i + length - d)) for d in range(1, q)):
                out.append((i, length, q))
            i = max(j, i + 1)
    return sorted(out, key=lambda r: (r[0], r[2]))


def periodic_text(rnd):
    words, letters, most = [], rnd.randint(1, 4), rnd.choice([0, 10, 60, 200])
    while len(words) < most:
        base = [rnd.choice("abcdefgh"[:letters]) for _ in range(rnd.randint(1, 12))]
        words += (base * 12)[: rnd.randint(1, 6 * len(base))] if rnd.random() < 0.7 else [str(rnd.random())]
    return [w.encode() for w in words]


def test_runs_equal_brute_force():
    rnd = random.Random(2)
    for _ in range(400):
        batch = [periodic_text(rnd) for _ in range(rnd.randint(1, 6))]
        assert periodic.runs_of(batch) == [brute_runs(w) for w in batch]
    batch = [periodic_text(rnd) for _ in range(50)]
    assert periodic.runs_of(batch, 3, 5) == [brute_runs(w, 3, 5) for w in batch]


def test_rare_words_split_until_nothing_changes():
    rnd = random.Random(3)
    for _ in range(300):
        words = periodic_text(rnd)
        left = periodic.surviving(words)
        assert all(b - a >= 6 and min(collections.Counter(words[a:b]).values()) >= 4 for a, b in left)
        covered = {i for a, b in left for i in range(a, b)}
        assert all(set(range(s, s + n)) <= covered for s, n, _ in brute_runs(words))
    chain = [b"%d" % (k // 2) for k in range(40_000)]  # each split makes the next words rare
    assert periodic.surviving(chain) == []


@pytest.mark.parametrize("words", [[b"a"] * 200_000, [b"a", b"b"] * 100_000, ([b"a"] * 20_000 + [b"b"]) * 5], ids=["one", "two", "blocks"])
def test_long_repeats_take_few_steps(words):
    found = periodic.runs_of([words])[0]
    assert (0, len(words), {200_000: len(set(words)), 100_005: 20_001}[len(words)]) in found


def mutated(doc_id, text):
    words, h = WORD.findall(text), zlib.crc32(str(doc_id).encode())
    n, g = len(words), h // 10
    if h % 10 == 0 and n:
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        words = words[:a] + [words[a + (i - a) % p] for i in range(a, n)]
    return [w.encode() for w in words]


def brute_digests(doc_id, text):
    words = mutated(doc_id, text)
    runs = brute_runs(words)
    dropped = {i for s, n, p in runs for i in range(s + p, s + n)}
    best = min(runs, key=lambda r: (-r[1] / r[2], r[0], r[2]), default=(None,) * 3)
    listed = "".join(f"{s},{n},{p}\n" for s, n, p in runs)
    return (len(words), len(runs), *best, best[1] and 1000 * best[1] // best[2], sha(listed), sha(b" ".join(w for i, w in enumerate(words) if i not in dropped)))


COLUMNS_11 = ("n_words", "n_runs", "start", "length", "period", "exponent_milli", "runs_sha256", "collapsed_sha256")


def test_op11_equals_brute_force(spark, texts):
    got = {r.doc_id: tuple(r[c] for c in COLUMNS_11) for r in queries.queries()["op11_periodic"](spark, SF_DIR).collect()}
    assert got.keys() == texts.keys() and sum(r[1] > 0 for r in got.values()) > 10
    for i, t in texts.items():
        if len(t) < 40_000:
            assert got[i] == brute_digests(i, t), i


def test_op11_strongest_is_exact_and_first(spark):
    lists = [[(0, 9, 2), (20, 18, 4), (50, 5, 1)], [(0, 8, 2), (9, 4, 1)], [(3, 3_000_000_001, 3), (5, 10**9, 1)], []]
    df = spark.createDataFrame([(k, x) for k, x in enumerate(lists)], "k int, runs array<struct<start:long,length:long,period:long>>")
    got = {r.k: r.b and tuple(r.b) for r in df.select("k", periodic.strongest(F.col("runs")).alias("b")).collect()}
    assert got == {0: (50, 5, 1), 1: (0, 8, 2), 2: (3, 3_000_000_001, 3), 3: None}


def test_op11_awkward(docs, empty):
    rows = periodic.find_runs(docs).collect()
    assert collections.Counter(r.doc_id for r in rows) == collections.Counter(x[0] for x in AWKWARD) and rows[0].items == "?"
    for r in rows:
        words = WORD.findall(r.text or "")
        assert r.n_words == len(words)
        if len(words) < 1000:
            assert [tuple(x) for x in r.runs] == brute_runs(words)
    long = next(r for r in rows if r.doc_id == 6)
    assert [tuple(x) for x in long.runs] == [(0, 40_000, 1)] and long.collapsed == "word"
    assert periodic.find_runs(empty).collect() == [] and periodic.run_digests(empty).collect() == []
    digests = {r.doc_id: r for r in periodic.run_digests(docs.where("doc_id IS NULL OR doc_id < 4")).collect()}
    assert digests[1].n_runs == 0 and digests[1].start is None and digests[1].runs_sha256 == digests[1].collapsed_sha256 == sha("")
    assert digests[None].n_words == len(WORD.findall(AWKWARD[3][1]))  # a null id has no hash, so its text stays as it is


# --- 12 -----------------------------------------------------------------------------------------------------------


def brute_hits(docs, items, width=10):
    windows = collections.defaultdict(set)
    for i, t in items:
        w = terms(t)
        for k in range(len(w) - min(width, len(w)) + 1 if w else 0):
            windows[tuple(w[k : k + width])].add(i)
    out = []
    for i, t in docs:
        w, hit, found = terms(t), set(), set()
        for size in {len(x) for x in windows}:
            for k in range(len(w) - size + 1):
                if (x := tuple(w[k : k + size])) in windows:
                    hit |= set(range(k, k + size))
                    found |= windows[x]
        found = sorted(str(x) for x in found if x is not None)
        out.append((i, len(w), len(hit), len(found), sha(",".join(found)), bool(hit)))
    return out


def order(rows):
    return sorted((tuple(r) for r in rows), key=lambda r: [(x is None, x) for x in r])


def test_op12_equals_brute_force(spark, texts, items):
    got = queries.queries()["op12_decontamination"](spark, SF_DIR).collect()
    want = brute_hits(texts.items(), items)
    assert order(got) == order(want) and sum(r[-1] for r in want) >= 3


def test_op12_planted(spark):
    """Random texts over few words, items of 1 to 25 words among them, at starts and ends, overlapping and repeated."""
    rnd = random.Random(8)
    line = lambda n: " ".join(rnd.choice("alpha Beta gamma, delta eps é1 中".split()) for _ in range(n))
    items = [(k, line(rnd.choice([3, 5, 9, 10, 11, 25]))) for k in range(60)] + [(7, "Single"), (None, line(12)), (900, None), (901, ""), (902, "...")]
    items += items[:5]
    docs = [(k, " ".join([line(rnd.randint(0, 40)), *(rnd.choice(items)[1] or "" for _ in range(rnd.randint(0, 3))), line(rnd.randint(0, 40))])) for k in range(80)]
    docs += [(80, items[0][1]), (81, items[6][1].upper() + " " + items[6][1]), (82, None), (83, ""), (None, items[61][1]), (84, "single SINGLE"), (84, "single SINGLE")]
    d, i = spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string")
    got = decontamination.contaminated(d, i).collect()
    assert order(got) == order(brute_hits(docs, items))


def test_op12_hits_are_stretches_and_shares(spark):
    item = "one two three four five six seven eight nine ten eleven twelve"
    docs = [(1, "x " + item + " y " + item), (2, item.replace("three", "drei")), (3, "one two three four five six seven eight nine"), (4, item.replace("six", "sechs"))]
    d, i = spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame([(5, item)], "item_id long, text string")
    found = {r.doc_id: ([tuple(h) for h in r.hits], r["items"]) for r in decontamination.contamination(d, i).collect()}
    assert found == {1: ([(1, 13), (14, 26)], ["5"]), 2: ([], []), 3: ([], []), 4: ([], [])}
    # of the six shingles of a window three are enough: only those behind "three" are whole in text 2, none in text 4
    some = {r.doc_id: [tuple(h) for h in r.hits] for r in decontamination.contamination(d, i, containment=0.5).collect()}
    assert some == {1: [(1, 13), (14, 26)], 2: [(0, 12)], 3: [], 4: []}


def test_op12_awkward(spark, docs, empty):
    i = spark.createDataFrame([(1, "Some words of a row without an id, some more."), (2, "word " * 30), (None, None)], "item_id long, text string")
    rows = decontamination.contamination(docs, i).collect()
    assert sorted((r.doc_id or 0, r.n_words, r.n_hit, r.n_items) for r in rows if r.n_hit) == [(0, 10, 10, 1), (6, 40_000, 40_000, 1)]
    assert len(rows) == len(AWKWARD) and rows[0].weight == "?" and [r.n_words for r in rows if r.doc_id == 1] == [0]
    assert decontamination.contaminated(empty, i).collect() == []
    none = decontamination.contaminated(docs, i.limit(0)).collect()
    assert len(none) == len(AWKWARD) and not any(r.contaminated for r in none)


# --- 13 -----------------------------------------------------------------------------------------------------------


def grams(text, n):
    w = terms(text)
    return [" ".join(w[k : k + m]) for m in range(1, n + 1) for k in range(len(w) - m + 1)]


def brute_sample(docs, target, p=resampling.Resampling()):
    bucket = lambda g: zlib.crc32(g.encode()) % p.buckets
    s = collections.Counter(bucket(g) for _, t in docs for g in grams(t, p.most_n))
    t = collections.Counter(bucket(g) for x in target for g in grams(x, p.most_n))
    all_s, all_t = sum(s.values()), sum(t.values())
    gain = [math.floor(p.scale * math.log((t[b] + 1) * (all_s + p.buckets) / ((s[b] + 1) * (all_t + p.buckets)))) for b in range(p.buckets)]
    rows = []
    for i, x in docs:
        g = grams(x, p.most_n)
        h = int(hashlib.sha256(f"{p.seed}{'' if i is None else i}".encode()).hexdigest()[:8], 16)
        weight = sum(gain[bucket(y)] for y in g)
        rows.append([i, len(g), weight, weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296))), len(terms(x))])
    able = sorted((r for r in rows if r[4] >= p.least_words), key=lambda r: (-r[3], r[0] is None, r[0]))
    rank = {id(r): k + 1 for k, r in enumerate(able[: len(able) * p.percent // 100])}
    return [(*r[:4], rank.get(id(r))) for r in rows]


def test_op13_equals_brute_force(spark, texts, items):
    got = queries.queries()["op13_resampling"](spark, SF_DIR).collect()
    assert order(got) == order(brute_sample(texts.items(), [t for _, t in items]))


def test_op13_longer_grams_cross_lines(spark):
    rnd = random.Random(4)
    line = lambda: " ".join(rnd.choice("Aa bb, cc\x00dd éß 中文 x9".split()) for _ in range(rnd.randint(0, 7)))
    docs = [(k, "\n".join(line() for _ in range(rnd.randint(1, 9)))) for k in range(60)] + [(60, None), (61, "\n\n"), (None, "bb cc " * 10)]
    target = [line() for _ in range(20)] + [None]
    p = resampling.Resampling(most_n=3, buckets=300, percent=30, least_words=5)
    d, t = spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame([(x,) for x in target], "text string")
    got = resampling.resample(d, t, p).select("doc_id", "n_features", "weight", "score", "rank").collect()
    assert order(got) == order(brute_sample(docs, target, p))


def test_op13_ranks_go_over_partitions(spark):
    rows = [(k, 20 + k % 2, (k * 7919) % 500, k) for k in range(3000)] + [(k, 3, 10**6, k) for k in range(3000, 3100)]
    p = resampling.Resampling(percent=50)
    got = resampling.ranked(spark.createDataFrame(rows, "doc_id long, n_words long, score long, th long").repartition(7), p).collect()
    want = {r[0]: k + 1 for k, r in enumerate(sorted((r for r in rows if r[1] >= 20), key=lambda r: (-r[2], r[0]))[:1500])}
    assert {r.doc_id: r["rank"] for r in got if r["rank"]} == want and len(got) == 3100


def test_op13_awkward(spark, docs, empty, items):
    target = spark.createDataFrame([(t,) for _, t in items], "text string")
    got = resampling.importance_sample(docs, target).collect()
    want = brute_sample([(x[0], x[1]) for x in AWKWARD], [t for _, t in items])
    assert order(got) == order(want)
    assert resampling.importance_sample(empty, target).collect() == []
    assert len(resampling.importance_sample(docs, target.limit(0)).collect()) == len(AWKWARD)


# --- words --------------------------------------------------------------------------------------------------------


def test_words_equal_the_expression():
    rnd = random.Random(1)
    for _ in range(200):
        some = ["".join(rnd.choice("aB9 é\n.中`{Z@\x7f\x80") for _ in range(rnd.randint(0, 30))) for _ in range(rnd.randint(0, 6))]
        w = W.words_of(pa.array(["x", *(t + "\n" for t in some), "zz"])[1:-1])
        got = [w.buf[a:b].tobytes().decode() for a, b in zip(w.start, w.end)]
        assert got == [x for t in some for x in terms(t)] and w.counts.tolist() == [len(terms(t)) for t in some]
        assert W.checksums(w.buf, w.start, w.end).tolist() == [zlib.crc32(x.encode()) for x in got]
        assert len(set(zip(got, W.hashes(w).tolist()))) == len(set(got)) == len(set(W.hashes(w).tolist()))
    long = W.words_of(pa.array(["é" * 70 + "\n"]))
    assert W.checksums(long.buf, long.start, long.end).tolist() == [zlib.crc32(("é" * 70).encode())]
