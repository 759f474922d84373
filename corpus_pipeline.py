"""The corpus pipeline: documents in, packed sequences out. Each stage's result is written and read again."""

from __future__ import annotations

import uuid

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from chainframe.llm import linededup, packing, secretscan, simhash, toxicity
from chainframe.llm.common import documents, materialize, shared_folder

COLUMNS = ("doc_id", "text", "lang", "source", "n_chars")


def with_text(docs: DataFrame, text) -> DataFrame:
    """``docs`` with a new text and its length."""
    return docs.select("doc_id", text.alias("text"), "lang", "source", F.char_length(F.coalesce(text, F.lit(""))).cast("long").alias("n_chars"))


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents predicted toxic go. A null or empty text has the bias only and stays unless that alone is toxic; repeated
    rows go or stay alike; texts of any length are scored whole; columns but those of documents are left behind; an empty
    table stays empty."""
    p = toxicity.Ftrl()
    weights = toxicity.train(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"), p)
    scored = toxicity.score(docs.select(*COLUMNS), weights, p)
    return scored.where(F.col("score") < p.threshold).select(*COLUMNS)


def drop_repeated_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Lines that ten documents or more have go; documents stay, even if empty then. A null text stays null; repeated rows
    lose the same lines; rows without a doc_id count as one document; texts of any length are split whole; columns but
    those of documents are left behind; an empty table stays empty."""
    done = linededup.dedup_lines(docs.select(*COLUMNS).drop("n_chars"))
    return with_text(done, F.when(F.col("n_dropped") > 0, F.col("kept")).otherwise(F.col("text")))


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of each component stays: that with the smallest doc_id (null last), then with the least hash of its text. Of
    rows that are alike in both one stays. Null and empty texts, and those without words, are one component. Texts of any
    length are hashed whole; columns but those of documents are left behind; an empty table stays empty."""
    docs = docs.select(*COLUMNS, F.xxhash64(F.coalesce("text", F.lit(""))).alias("th"))
    rows = materialize(simhash.near_duplicates(docs, carry=("th",)).groupBy("root", "doc_id", "th").agg(F.count("*").alias("n")))
    # a table of its own, so that the rows of a hot component can be split over tasks
    best = materialize(rows.groupBy("root").agg(F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "th")).alias("best")))
    marked = rows.join(best, "root").withColumn("stays", F.col("doc_id").eqNullSafe(F.col("best.doc_id")) & (F.col("th") == F.col("best.th")))

    def these(which: DataFrame, how: str, of: DataFrame) -> DataFrame:
        w = which.select(F.col("doc_id").alias("w_id"), F.col("th").alias("w_th"))
        return of.join(w, of["doc_id"].eqNullSafe(w["w_id"]) & (of["th"] == w["w_th"]), how)

    kept = these(marked.where("NOT stays"), "left_anti", docs)
    again = materialize(marked.where("stays AND n > 1").select("doc_id", "th"))
    if not again.isEmpty():  # only the rows that are alike are compared
        kept = these(again, "left_anti", kept).unionByName(these(again, "left_semi", kept).dropDuplicates(["doc_id", "th"]))
    return kept.select(*COLUMNS)


def redact_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Secrets are replaced by their kind; documents stay. A null text stays null; repeated rows are redacted alike; texts of
    any length are scanned whole; columns but those of documents are left behind; an empty table stays empty."""
    done = secretscan.scan(docs.select(*COLUMNS), redact=True)
    return with_text(done, F.col("text"))


def pack_documents(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents packed into sequences, a row per piece: see packing.pack, which says what null and empty texts,
    repeated rows, rows without a doc_id and empty tables give."""
    return packing.pack(docs, public_tokenizers.path("byte_bpe_50k.json"))


STAGES = [
    ("toxicity", drop_toxic),
    ("line_dedup", drop_repeated_lines),
    ("near_dedup", drop_near_duplicates),
    ("secrets", redact_secrets),
    ("packing", pack_documents),
]

#: SQL has neither the classifier nor the tokenizer.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``."""
    docs, folder = documents(spark, sf_dir), f"{shared_folder(spark)}/pipeline-{uuid.uuid4().hex}"
    for k, (name, stage) in enumerate(STAGES):
        out = stage(spark, docs, sf_dir)
        if k == len(STAGES) - 1:
            return out
        out.write.parquet(f"{folder}/{k}_{name}")
        docs = spark.read.parquet(f"{folder}/{k}_{name}")
    return docs
