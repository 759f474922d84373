"""Comparison of two stores by key, with differences that are explained and tolerated by rule.

``a`` is the store under test, ``b`` the other one. Chains and floors come as tables; verdicts are one row, and comparing
nothing is never a pass.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from chainframe.operators.aggregates import bucket_digest, row_md5

BLOCK, TX = ["chain_id", "block_number"], ["chain_id", "block_number", "transaction_index"]


def paired(a: DataFrame, b: DataFrame, keys: list[str], columns: list[str]) -> DataFrame:
    """Full outer join on the keys: a and b as structs of ``columns``."""
    return a.select(*keys, F.struct(*columns).alias("a")).join(b.select(*keys, F.struct(*columns).alias("b")), keys, "full_outer")


def status(columns: list[str]) -> Column:
    same = reduce(lambda x, y: x & y, (F.col(f"a.{c}").eqNullSafe(F.col(f"b.{c}")) for c in columns))
    return F.when(F.col("a").isNull(), "only_b").when(F.col("b").isNull(), "only_a").when(same, "shared").otherwise("mismatch")


def diff_by_key(a: DataFrame, b: DataFrame, keys: list[str], exclude: tuple[str, ...] = (), mode: str = "strict", samples: int = 6) -> DataFrame:
    """(status, n, sample, tolerated): keys that are shared, mismatch, only_a or only_b, with the least few keys as text.

    Modes: strict; blocks tolerates only_b; transactions is strict as well.
    """
    columns = [c for c in a.columns if c not in keys and c not in exclude]
    j = (
        a.select(*keys, row_md5(columns).alias("a"))
        .join(b.select(*keys, row_md5(columns).alias("b")), keys, "full_outer")
        .withColumn("status", F.when(F.col("a").isNull(), "only_b").when(F.col("b").isNull(), "only_a").when(F.col("a") == F.col("b"), "shared").otherwise("mismatch"))
    )
    key = F.concat_ws("-", *(F.lpad(F.col(k).cast("string"), 12, "0") for k in keys))
    n = j.groupBy("status").agg(F.count("*").alias("n"))
    # the least keys per status: Spark keeps the first few of each task before it shuffles them
    w = Window.partitionBy("status").orderBy("k")
    few = j.where("status <> 'shared'").select("status", key.alias("k")).withColumn("r", F.row_number().over(w)).where(F.col("r") <= samples)
    few = few.groupBy("status").agg(F.array_join(F.array_sort(F.collect_list("k")), ",").alias("sample"))
    fine = (F.col("status") == "shared") | ((F.col("status") == "only_b") & F.lit(mode == "blocks"))
    return n.join(few, "status", "left").select("status", "n", F.coalesce("sample", F.lit("")).alias("sample"), fine.alias("tolerated"))


def diff_columns(a: DataFrame, b: DataFrame, keys: list[str], exclude: tuple[str, ...] = ()) -> DataFrame:
    """Keys of both sides that differ, with the names of the differing columns, comma-joined; nulls compare as values."""
    columns = [c for c in a.columns if c not in keys and c not in exclude]
    names = F.array_compact(F.array(*(F.when(~F.col(f"a.{c}").eqNullSafe(F.col(f"b.{c}")), F.lit(c)) for c in columns)))
    j = paired(a, b, keys, columns).where("a IS NOT NULL AND b IS NOT NULL").select(*keys, "a", "b", F.array_join(names, ",").alias("columns"))
    return j.where("columns <> ''")


def tolerate_size_only(diff: DataFrame, hash_column: str = "block_hash") -> Column:
    """Only ``size`` differs, and the hashes are there and equal."""
    return (F.col("columns") == "size") & F.col(f"a.{hash_column}").isNotNull() & (F.col(f"a.{hash_column}") == F.col(f"b.{hash_column}"))


def tolerate_base_fee_null(diff: DataFrame, chains: list[int], hash_column: str = "block_hash") -> Column:
    """Only the base fee differs: null in a, 0 in b, equal hashes, on a chain in scope."""
    return (
        (F.col("columns") == "base_fee") & F.col("a.base_fee").isNull() & (F.col("b.base_fee") == 0)
        & F.col(f"a.{hash_column}").eqNullSafe(F.col(f"b.{hash_column}")) & F.col("chain_id").isin(chains)
    )


def tolerate_access_list_gap(diff: DataFrame, chains: list[int]) -> Column:
    """Only the access list differs, and it is null in a, on a chain in scope."""
    return (F.col("columns") == "access_list") & F.col("a.access_list").isNull() & F.col("chain_id").isin(chains)


def _verdict(a: DataFrame, b: DataFrame, keys: list[str], exclude: tuple[str, ...], classes: dict[str, Column], only_b_fine: bool) -> DataFrame:
    columns = [c for c in a.columns if c not in keys and c not in exclude]
    names = F.array_compact(F.array(*(F.when(~F.col(f"a.{c}").eqNullSafe(F.col(f"b.{c}")), F.lit(c)) for c in columns)))
    both = F.col("a").isNotNull() & F.col("b").isNotNull()
    j = paired(a, b, keys, columns).withColumn("columns", F.when(both, F.array_join(names, ",")))
    kind = F.when(F.col("a").isNull(), "only_b").when(F.col("b").isNull(), "only_a").when(F.col("columns") == "", "shared")
    for name, test in classes.items():
        kind = kind.when(F.coalesce(test, F.lit(False)), name)
    j = j.withColumn("kind", kind.otherwise("mismatch"))
    names_ = ["shared", *classes, "mismatch", "only_a", "only_b"]
    s = j.agg(*(F.count_if(F.col("kind") == n).alias(n) for n in names_))
    fails = F.col("mismatch") + F.col("only_a") + (F.lit(0) if only_b_fine else F.col("only_b"))
    return s.withColumn("verdict", F.when(fails > 0, "FAIL").when(F.col("shared") + sum(F.col(c) for c in classes) == 0, "EMPTY").otherwise("PASS"))


def blocks_verdict(a: DataFrame, b: DataFrame, base_fee_chains: list[int]) -> DataFrame:
    """One row of counts and PASS, FAIL or EMPTY. Blocks only in b are fine; two classes of difference are tolerated."""
    classes = {"size_only": tolerate_size_only(a), "base_fee_null": tolerate_base_fee_null(a, base_fee_chains)}
    return _verdict(a, b, BLOCK, ("total_difficulty",), classes, True)


def transactions_verdict(a: DataFrame, b: DataFrame, access_list_chains: list[int]) -> DataFrame:
    """Strict on both sides; one class of difference is tolerated."""
    return _verdict(a, b, TX, (), {"access_list_gap": tolerate_access_list_gap(a, access_list_chains)}, False)


def classify_only_b(a: DataFrame, b: DataFrame, floors: DataFrame, keys: list[str] = BLOCK) -> DataFrame:
    """Rows that only b has, with ``class``: tolerated if the chain has a floor and the block lies between the floor and
    the window's end (floors: chain_id, floor, window_end); otherwise hard. Unknown chains are hard."""
    only = b.join(a.select(*keys), keys, "left_anti").join(floors, "chain_id", "left")
    fine = F.coalesce(F.col("block_number").between(F.col("floor"), F.col("window_end")), F.lit(False))
    return only.select(*keys, F.when(fine, "tolerated").otherwise("hard").alias("class"))


def classify_only_b_tx(a: DataFrame, b: DataFrame, a_blocks: DataFrame, floors: DataFrame) -> DataFrame:
    """As classify_only_b for transactions, whose block must be absent from a as a whole."""
    c = classify_only_b(a, b, floors, TX)
    there = a_blocks.select(*BLOCK).distinct().withColumn("there", F.lit(True))
    return c.join(there, BLOCK, "left").select(*TX, F.when(F.col("there"), "hard").otherwise(F.col("class")).alias("class"))


def classify_shared_tx(a: DataFrame, b: DataFrame, pins: DataFrame) -> DataFrame:
    """Shared transactions that differ, with ``class``: pinned (a known pair of concrete lists: pins has tx_hash),
    a-null (the list is null in a and nothing else differs) or mismatch."""
    d = diff_columns(a, b, TX).withColumn("tx_hash", F.col("a.tx_hash")).join(pins.select("tx_hash", F.lit(True).alias("pin")), "tx_hash", "left")
    list_only = F.col("columns") == "access_list"
    concrete = F.col("a.access_list").isNotNull() & F.col("b.access_list").isNotNull()
    kind = F.when(list_only & concrete & F.col("pin"), "pinned").when(list_only & F.col("a.access_list").isNull(), "a-null").otherwise("mismatch")
    return d.select(*TX, kind.alias("class"))


def classify_tx_diff(a: DataFrame, b: DataFrame, logs: DataFrame) -> DataFrame:
    """Transactions that differ, with ``class``: referenced (only in a, and a log refers to it), unreferenced, only_b,
    mismatch. All but the first fail."""
    columns = [c for c in a.columns if c not in TX]
    j = paired(a, b, TX, columns).withColumn("status", status(columns)).where("status <> 'shared'")
    used = logs.select(*TX).distinct().withColumn("used", F.lit(True))
    j = j.join(used, TX, "left")
    kind = F.when((F.col("status") == "only_a") & F.col("used"), "referenced").when(F.col("status") == "only_a", "unreferenced").otherwise(F.col("status"))
    return j.select(*TX, kind.alias("class"), (kind != "referenced").alias("fails"))


def compare_buckets(a: DataFrame, b: DataFrame) -> DataFrame:
    """Bucket digests of both stores, with ``status``: match, mismatch, or edge (one store lacks the bucket)."""
    j = a.select("chain_id", "bucket", F.col("digest").alias("a_digest")).join(b.select("chain_id", "bucket", F.col("digest").alias("b_digest")), ["chain_id", "bucket"], "full_outer")
    s = F.when(F.col("a_digest").isNull() | F.col("b_digest").isNull(), "edge").when(F.col("a_digest") == F.col("b_digest"), "match").otherwise("mismatch")
    return j.select("chain_id", "bucket", s.alias("status"))


def explain_buckets(a: DataFrame, b: DataFrame, tolerated: DataFrame, keys: list[str], width: int = 1000) -> DataFrame:
    """Buckets that mismatch, with ``explained``: b's bucket without its tolerated rows (by key) has a's digest."""
    order = keys
    da, db = bucket_digest(a, order, width=width), bucket_digest(b, order, width=width)
    bad = compare_buckets(da, db).where("status = 'mismatch'")
    buckets = F.floor(F.col("block_number") / width).cast("long").alias("bucket")
    inside = b.withColumn("bucket", buckets).join(bad.select("chain_id", "bucket"), ["chain_id", "bucket"], "left_semi").select(*b.columns)
    again = bucket_digest(inside.join(tolerated.select(*keys), keys, "left_anti").select(*b.columns), order, width=width)
    j = bad.join(da.select("chain_id", "bucket", F.col("digest").alias("d")), ["chain_id", "bucket"]).join(again.select("chain_id", "bucket", F.col("digest").alias("e")), ["chain_id", "bucket"], "left")
    return j.select("chain_id", "bucket", F.coalesce(F.col("d") == F.col("e"), F.lit(False)).alias("explained"))


def overlap_window(a: DataFrame, b: DataFrame, cutovers: DataFrame, margin: int) -> DataFrame:
    """Per chain (cutovers: chain_id, cutover) the blocks to compare, each side's lag, and READY or PENDING."""
    ma = a.groupBy("chain_id").agg(F.max("block_number").alias("max_a"))
    mb = b.groupBy("chain_id").agg(F.max("block_number").alias("max_b"))
    j = cutovers.join(ma, "chain_id", "left").join(mb, "chain_id", "left")
    both = F.col("max_a").isNotNull() & F.col("max_b").isNotNull()
    hi, top = F.when(both, F.least("max_a", "max_b") - margin), F.greatest("max_a", "max_b")
    return j.select(
        "chain_id", F.col("cutover").alias("lo"), hi.alias("hi"), (top - F.col("max_a")).alias("lag_a"), (top - F.col("max_b")).alias("lag_b"),
        F.when(F.coalesce(hi >= F.col("cutover"), F.lit(False)), "READY").otherwise("PENDING").alias("state"),
    )


def digest_tree(digests: DataFrame, fan: int = 1000) -> DataFrame:
    """(chain_id, level, node, digest) over bucket digests (chain_id, bucket, digest): level 0 is the buckets, level 1 has a
    node for ``fan`` of them, level 2 one for ``fan`` of those and so on to level 3, the chain. Kept beside a store, it is
    added to as buckets are."""
    out = digests.select("chain_id", F.lit(0).alias("level"), F.col("bucket").alias("node"), "digest")
    level = out
    for k in (1, 2, 3):
        node = F.floor(F.col("node") / fan).cast("long") if k < 3 else F.lit(0).cast("long")
        listed = F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("node", "digest"))), lambda x: F.concat_ws(":", x["node"].cast("string"), x["digest"])), ",")
        level = level.groupBy("chain_id", node.alias("parent")).agg(F.md5(listed.cast("binary")).alias("digest"))
        level = level.select("chain_id", F.lit(k).alias("level"), F.col("parent").alias("node"), "digest")
        out = out.unionByName(level)
    return out


def differing_buckets(a: DataFrame, b: DataFrame, fan: int = 1000) -> DataFrame:
    """(chain_id, bucket) in which two digest trees differ, found from the top: a level's nodes are looked at only below
    nodes that differ. A bucket that one side lacks differs."""
    down = None
    for k in (3, 2, 1, 0):
        x, y = (t.where(F.col("level") == k).select("chain_id", "node", F.col("digest").alias(n)) for t, n in ((a, "da"), (b, "db")))
        if down is not None:
            parent = F.floor(F.col("node") / fan).cast("long") if k < 2 else F.lit(0).cast("long")
            x, y = (t.withColumn("parent", parent).join(down, ["chain_id", "parent"], "left_semi").drop("parent") for t in (x, y))
        met = x.join(y, ["chain_id", "node"], "full_outer").where(~F.col("da").eqNullSafe(F.col("db")))
        down = met.select("chain_id", F.col("node").alias("parent"))
    return down.select("chain_id", F.col("parent").alias("bucket"))


def family_classes(a: DataFrame, b: DataFrame, keys: list[str], window: DataFrame, floors: DataFrame, width: int = 1000, trees: tuple[DataFrame, DataFrame] | None = None, exclude: tuple[str, ...] = ()) -> DataFrame:
    """Per chain of ``window`` (chain_id, lo, hi): rows that only b has, tolerated (see classify_only_b) or hard, rows that
    mismatch, rows that only a has, buckets that differ, and how many of those tolerated rows explain.

    Only rows of buckets that differ are read a second time, with ``trees`` of both stores (of the same width) only those and
    the buckets that the window cuts: a bucket is explained if it has no difference but tolerated rows.
    """
    columns = [c for c in a.columns if c not in keys and c not in exclude]
    bucket = F.floor(F.col("block_number") / width).cast("long")

    def inside(df: DataFrame) -> DataFrame:
        return df.select(*keys, *columns).join(F.broadcast(window.select("chain_id", "lo", "hi")), "chain_id").where("block_number BETWEEN lo AND hi").drop("lo", "hi")

    if trees is None:
        da, db = (bucket_digest(inside(t), keys, width=width).select("chain_id", "bucket", F.col("digest").alias(n)) for t, n in ((a, "da"), (b, "db")))
        bad = da.join(db, ["chain_id", "bucket"], "full_outer").where(~F.col("da").eqNullSafe(F.col("db"))).select("chain_id", "bucket")
    else:
        first, last = (F.floor(F.col(c) / width).cast("long") for c in ("lo", "hi"))
        near = differing_buckets(*trees).join(F.broadcast(window), "chain_id").where(F.col("bucket").between(first, last)).select("chain_id", "bucket")
        bad = near.unionByName(window.select("chain_id", F.explode(F.array(first, last)).alias("bucket"))).distinct()

    def rows(df: DataFrame, name: str) -> DataFrame:
        own = inside(df).withColumn("bucket", bucket).join(bad, ["chain_id", "bucket"], "left_semi")
        return own.select(*keys, "bucket", row_md5(columns).alias(name))

    j = rows(a, "a").join(rows(b, "b"), [*keys, "bucket"], "full_outer").where(~F.col("a").eqNullSafe(F.col("b"))).join(F.broadcast(floors), "chain_id", "left")
    fine = F.coalesce(F.col("block_number").between(F.col("floor"), F.col("window_end")), F.lit(False))
    kind = F.when(F.col("a").isNotNull() & F.col("b").isNotNull(), "mismatch").when(F.col("a").isNotNull(), "only_a").when(fine, "tolerated").otherwise("hard")
    counts = {n: F.count_if(F.col("kind") == n) for n in ("tolerated", "hard", "mismatch", "only_a")}
    per = j.select("chain_id", "bucket", kind.alias("kind")).groupBy("chain_id", "bucket").agg(*(c.alias(n) for n, c in counts.items()))
    explained = F.col("hard") + F.col("mismatch") + F.col("only_a") == 0
    return per.groupBy("chain_id").agg(*(F.sum(n).alias(n) for n in counts), F.count("*").alias("buckets"), F.count_if(explained).alias("explained"))


def compare_chain(
    a: DataFrame, b: DataFrame, cutovers: DataFrame, floors: DataFrame, pins: DataFrame, margin: int, stagnation: DataFrame | None = None, others: dict[str, tuple[DataFrame, DataFrame, list[str]]] | None = None, width: int = 1000,
    trees: dict[str, tuple[DataFrame, DataFrame]] | None = None,
) -> DataFrame:
    """One row per chain over its overlap: counts of each class of transactions and of the other families' rows, and PASS,
    FAIL or PENDING.

    ``stagnation`` (chain_id, failing) fails a chain whose progress does, with an overlap or without: a stuck side is just
    what keeps an overlap from opening. ``others`` are the other families by name, such as logs and blocks: both sides and
    their keys; see family_classes for their classes, counted as CLASS_NAME. Rows that only b has are tolerated above the
    chain's floor; of transactions only those of blocks that a lacks as a whole, by the family ``blocks`` if it is given.
    Anything else that differs fails the chain. A chain of which nothing was compared isn't a pass. ``trees``: digest trees
    of other families' stores, by name.
    """
    w = overlap_window(a, b, cutovers, margin)
    ready = w.where("state = 'READY'").select("chain_id", "lo", "hi")
    others = others or {}

    def inside(df: DataFrame) -> DataFrame:
        return df.join(ready, "chain_id").where("block_number BETWEEN lo AND hi").select(*df.columns)

    ia, ib = inside(a), inside(b)
    a_blocks = inside(others["blocks"][0]) if "blocks" in others else ia
    parts = [
        classify_only_b_tx(ia, ib, a_blocks, floors).select("chain_id", F.concat(F.lit("only_b_"), F.col("class")).alias("class")),
        classify_shared_tx(ia, ib, pins).select("chain_id", F.col("class")),
        ia.join(ib.select(*TX), TX, "left_anti").select("chain_id", F.lit("only_a").alias("class")),
    ]
    names = ("only_b_tolerated", "only_b_hard", "pinned", "a-null", "mismatch", "only_a")
    n = reduce(DataFrame.unionByName, parts).groupBy("chain_id").agg(*(F.count_if(F.col("class") == c).alias(c.replace("-", "_")) for c in names))
    cols = [c.replace("-", "_") for c in names]
    j = w.join(n, "chain_id", "left").join(ia.groupBy("chain_id").agg(F.count("*").alias("compared")), "chain_id", "left")
    j = j.select("chain_id", "lo", "hi", "state", *(F.coalesce(c, F.lit(0)).cast("long").alias(c) for c in [*cols, "compared"]))
    fails = F.col("only_b_hard") + F.col("mismatch") + F.col("only_a")
    for name, (x, y, keys) in others.items():
        classes = family_classes(x, y, keys, ready, floors, width, (trees or {}).get(name))
        own = [c for c in classes.columns if c != "chain_id"]
        j = j.join(classes.select("chain_id", *(F.col(c).alias(f"{c}_{name}") for c in own)), "chain_id", "left").fillna(0, [f"{c}_{name}" for c in own])
        fails = fails + F.col(f"hard_{name}") + F.col(f"mismatch_{name}") + F.col(f"only_a_{name}")
    j = j.join(stagnation.select("chain_id", "failing"), "chain_id", "left") if stagnation is not None else j.withColumn("failing", F.lit(False))
    bad = (fails > 0) | F.coalesce("failing", F.lit(False))
    verdict = F.when(bad, "FAIL").when((F.col("state") == "PENDING") | (F.col("compared") == 0), "PENDING").otherwise("PASS")
    return j.withColumn("verdict", verdict).drop("failing", "state")


def parity_report(bench: DataFrame, reference: DataFrame) -> DataFrame:
    """Cells (scope, field, value) of two snapshots side by side; an absent side is a mismatch. The row ``overall`` says
    whether all match."""
    j = bench.select("scope", "field", F.col("value").alias("bench")).join(reference.select("scope", "field", F.col("value").alias("reference")), ["scope", "field"], "full_outer")
    cells = j.select("scope", "field", "bench", "reference", F.coalesce(F.col("bench") == F.col("reference"), F.lit(False)).alias("match"))
    overall = cells.agg(F.coalesce(F.bool_and("match"), F.lit(False)).alias("match"))
    none = F.lit(None).cast("long")
    return cells.unionByName(overall.select(F.lit("overall").alias("scope"), F.lit("all").alias("field"), none.alias("bench"), none.alias("reference"), "match"))
