"""Each stage of the pipeline against brute force on its own input."""

import collections

import corpus_pipeline
import pytest
import public_tokenizers as P
import xxhash
from chainframe.llm import secretscan, simhash, toxicity
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from test_llm import AWKWARD, DOCUMENTS, SF_DIR, brute_components, brute_fingerprint, brute_lines, check_packing


def staged(spark, docs, folder):
    """Every stage's input and the last one's output."""
    out = [docs]
    for k, (_, stage) in enumerate(corpus_pipeline.STAGES):
        stage(spark, docs, SF_DIR).write.parquet(f"{folder}/{k}")
        docs = spark.read.parquet(f"{folder}/{k}")
        out.append(docs)
    return out


def brute_stay(rows):
    """Of each component the row with the least (doc_id, hash of the text), once."""
    components = collections.defaultdict(list)
    numbered = [(k, brute_fingerprint(t or "")) for k, (_, t) in enumerate(rows)]
    for r, c in zip(rows, brute_components(numbered)):
        components[c].append(r)
    th = lambda t: simhash.as_long(xxhash.xxh64_intdigest((t or "").encode(), 42))
    return [min(own, key=lambda r: (r[0] is None, r[0] or 0, th(r[1]))) for own in components.values()]


def test_near_duplicates_leave_one_row(spark):
    base = " ".join(f"word{k}" for k in range(60))
    rows = [(5, base), (5, "another text of its own"), (5, base), (9, base + " x"), (None, base), (None, "alone here"), (None, "alone here"), (7, None), (8, ""), (3, "another text of its own"), (2, "b " * 4000)]
    docs = spark.createDataFrame([(i, t, "en", "s", 0) for i, t in rows], DOCUMENTS).withColumn("th", F.lit(1)).withColumn("root", F.lit(1))
    got = [(r.doc_id, r.text) for r in corpus_pipeline.drop_near_duplicates(spark, docs, SF_DIR).collect()]
    assert sorted(got, key=str) == sorted(brute_stay(rows), key=str)
    assert len(got) == 5 and (5, base) in got and (3, "another text of its own") in got and (7, None) in got


@pytest.mark.parametrize("awkward", [False, True])
def test_stages(spark, tmp_path, awkward):
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    if awkward:
        docs = docs.unionByName(spark.createDataFrame([(None if a[0] is None else a[0] + 10**6, *a[1:]) for a in AWKWARD], DOCUMENTS))
    docs = docs.withColumn("start", F.lit("clash"))
    tables = staged(spark, docs, tmp_path)
    for t in tables[1:-1]:
        assert sorted(t.columns) == sorted(corpus_pipeline.COLUMNS)
    first, second, third, fourth, fifth = [[(r.doc_id, r.text) for r in t.select("doc_id", "text").collect()] for t in tables[:-1]]
    order = lambda rows: sorted(rows, key=str)

    labels = spark.read.parquet(f"{SF_DIR}/labels.parquet")
    toxic = {(r.doc_id) for r in toxicity.toxicity(docs, labels).where("predicted = 1").collect()}
    assert order(second) == order(r for r in first if r[0] not in toxic)
    clean = {r.doc_id for r in labels.where("toxic = 0").collect()}
    assert not clean & {i for i, _ in first} - {i for i, _ in second}

    assert sorted((str(i), t or "") for i, t in third) == sorted((i, t) for i, _, _, t in brute_lines(second, 10))

    fps = [(i, brute_fingerprint(t or "")) for i, t in third]
    assert order(fourth) == order(brute_stay(third))

    spans = secretscan.scan_block([t or "" for _, t in fourth], secretscan.RULES)
    want = [(i, secretscan.redacted(t, s, secretscan.RULES) if s else t) for (i, t), s in zip(fourth, spans)]
    assert order(fifth) == order(want)

    tokenizer = Tokenizer.from_file(P.path("byte_bpe_50k.json"))
    ids = {i: tokenizer.encode(t or "", add_special_tokens=False).ids + [1] for i, t in fifth}
    check_packing(tables[-1].collect(), ids, collections.Counter(i for i, _ in fifth))


def test_empty_tables(spark, tmp_path):
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet").limit(0)
    assert [t.count() for t in staged(spark, docs, tmp_path)] == [0] * 6


def test_run_is_the_stages(spark):
    assert corpus_pipeline.run(spark, SF_DIR).columns[:3] == ["doc_id", "start", "length"]
