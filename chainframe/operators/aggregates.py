"""Aggregations: snapshots, counters, digests and rates."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def closest_block(*families: DataFrame) -> DataFrame:
    """Per chain the highest block that any family has data of; no row where there is none."""
    parts = [f.groupBy("chain_id").agg(F.max("block_number").alias("b")) for f in families]
    return reduce(DataFrame.unionByName, parts).groupBy("chain_id").agg(F.max("b").alias("closest_block"))


def store_snapshot(blocks: DataFrame, txs: DataFrame, logs: DataFrame) -> DataFrame:
    """(scope, field, value): per chain the logs' count, least and greatest block and distinct transactions, and the
    store's totals of blocks and transactions."""
    per = logs.groupBy("chain_id", "tx_hash").agg(F.count("*").alias("n"), F.min("block_number").alias("lo"), F.max("block_number").alias("hi")).groupBy("chain_id").agg(
        F.sum("n").alias("logs"), F.min("lo").alias("min_block"), F.max("hi").alias("max_block"), F.count("tx_hash").alias("distinct_tx")
    )
    cells = F.inline(F.array(*(F.struct(F.lit(c).alias("field"), F.col(c).cast("long").alias("value")) for c in ("logs", "min_block", "max_block", "distinct_tx"))))
    out = per.select(F.concat(F.lit("chain-"), F.col("chain_id").cast("string")).alias("scope"), cells)
    for name, df in (("blocks", blocks), ("transactions", txs)):
        out = out.unionByName(df.agg(F.count("*").alias("value")).select(F.lit("store").alias("scope"), F.lit(name).alias("field"), "value"))
    return out


def events_per_label(labelled: DataFrame) -> DataFrame:
    """Counts per label, largest first."""
    return labelled.groupBy("label").agg(F.count("*").alias("n")).orderBy(F.desc("n"), "label")


def action_counters(events: DataFrame, action: str = "action") -> DataFrame:
    """Counts per action, and of all as ``global``."""
    g = events.rollup(action).agg(F.count("*").alias("n"), F.grouping(action).alias("g"))
    return g.select(F.when(F.col("g") == 1, "global").otherwise(F.col(action)).alias("action"), "n")


def vault_event_counts(vaults: DataFrame, events: DataFrame) -> DataFrame:
    """Events per vault (chain_id, vault) of ``vaults``; silent ones have 0."""
    n = events.groupBy("chain_id", "vault").agg(F.count("*").alias("n"))
    return vaults.select("chain_id", "vault").distinct().join(n, ["chain_id", "vault"], "left").select(
        F.concat_ws(":", F.col("chain_id").cast("string"), "vault").alias("id"), F.coalesce("n", F.lit(0)).cast("long").alias("event_count")
    )


def total_counts(tables: dict[str, tuple[DataFrame, dict[str, Column]]]) -> DataFrame:
    """(name, filter, total): each table's rows, and those of each named condition, in one pass a table."""
    out = []
    for name, (df, conditions) in tables.items():
        sums = df.agg(F.count("*").alias("all"), *(F.count_if(c).alias(k) for k, c in conditions.items()))
        cells = F.array(*(F.struct(F.lit(name).alias("name"), F.lit(k).alias("filter"), F.col(k).alias("total")) for k in ("all", *conditions)))
        out.append(sums.select(F.inline(cells)))
    return reduce(DataFrame.unionByName, out)


def row_md5(columns: list[str], null: str = "<null>") -> Column:
    return F.md5(F.concat_ws("|", *(F.coalesce(F.col(c).cast("string"), F.lit(null)) for c in columns)).cast("binary"))


def _in_order(order: list[str]) -> Column:
    """Hashes ``h`` of a group, ordered by ``order`` and then content, hashed."""
    return F.md5(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct(*order, "h"))), lambda x: x["h"]), "").cast("binary"))


def bucket_digest(df: DataFrame, order: list[str], exclude: tuple[str, ...] = (), width: int = 1000) -> DataFrame:
    """(chain_id, bucket, n_rows, digest) over the rows of ``width`` blocks."""
    columns = [c for c in df.columns if c not in exclude]
    hashed = df.select("chain_id", F.floor(F.col("block_number") / width).cast("long").alias("bucket"), *(c for c in order if c != "chain_id"), row_md5(columns).alias("h"))
    return hashed.groupBy("chain_id", "bucket").agg(F.count("*").alias("n_rows"), _in_order([c for c in order if c != "chain_id"]).alias("digest"))


def table_digest(df: DataFrame, name: str, order: list[str], exclude: tuple[str, ...] = (), width: int = 1000) -> DataFrame:
    """(table_name, n_rows, digest) in three levels: buckets of blocks; ``FAN`` neighbouring buckets' digests in order; and
    these groups' digests in order. What meets in a task at a time is a bucket's rows, a group's buckets, or one line for
    each width * FAN blocks."""
    buckets = bucket_digest(df, order, exclude, width).withColumn("part", F.floor(F.col("bucket") / FAN).cast("long"))
    groups = buckets.groupBy("chain_id", "part").agg(F.sum("n_rows").alias("n_rows"), _lines(F.col("bucket")).alias("digest"))
    return groups.agg(F.coalesce(F.sum("n_rows"), F.lit(0)).cast("long").alias("n_rows"), _lines(F.col("part")).alias("digest")).select(F.lit(name).alias("table_name"), "n_rows", "digest")


#: Buckets whose digests are hashed together.
FAN = 1000


def _lines(place: Column) -> Column:
    """The hash of a group's lines ``chain:place:digest``, in order."""
    line = F.struct("chain_id", place.alias("place"), F.concat_ws(":", F.col("chain_id").cast("string"), place.cast("string"), "digest").alias("line"))
    return F.md5(F.array_join(F.transform(F.array_sort(F.collect_list(line)), lambda x: x["line"]), "\n").cast("binary"))


def store_digest(tables: list[DataFrame]) -> DataFrame:
    """One digest over the tables' digests, by name."""
    all_ = reduce(DataFrame.unionByName, tables)
    line = F.concat(F.col("table_name"), F.lit("="), F.col("digest"), F.lit(":"), F.col("n_rows").cast("string"))
    return all_.agg(F.count("*").alias("tables"), F.md5(F.array_join(F.array_sort(F.collect_list(line)), "\n").cast("binary")).alias("digest"))


def app_digest(tables: dict[str, tuple[DataFrame, list[str]]], width: int = 1000) -> DataFrame:
    """(verdict, tables, n_rows, digest) over user tables; names with a leading underscore are internal. No rows at all is
    NO-USER-TABLES, which isn't a pass."""
    own = [table_digest(df, n, order, width=width) for n, (df, order) in tables.items() if not n.startswith("_")]
    all_ = reduce(DataFrame.unionByName, own).where("n_rows > 0")
    line = F.concat(F.col("table_name"), F.lit("="), F.col("digest"), F.lit(":"), F.col("n_rows").cast("string"))
    return all_.agg(
        F.when(F.count("*") == 0, "NO-USER-TABLES").otherwise("DIGEST").alias("verdict"),
        F.count("*").alias("tables"),
        F.coalesce(F.sum("n_rows"), F.lit(0)).cast("long").alias("n_rows"),
        F.when(F.count("*") > 0, F.md5(F.array_join(F.array_sort(F.collect_list(line)), "\n").cast("binary"))).alias("digest"),
    )


PERCENTILES = (("p50", 0.5), ("p90", 0.9), ("p95", 0.95), ("p99", 0.99))


def nearest_ranks(values: DataFrame, by: list[str], column: str, buckets: int = 4096) -> DataFrame:
    """Per group the PERCENTILES of ``column`` by nearest rank, without sorting a group: equal values are counted first, then
    by bucket of the group's range; only buckets that hold a wanted place are sorted, each by itself. A window has ``buckets``
    rows or a bucket's distinct values."""
    own = values.where(F.col(column).isNotNull()).groupBy(*by, column).agg(F.count("*").alias("c"))
    ends = own.groupBy(*by).agg(F.min(column).alias("__lo"), F.max(column).alias("__hi"))
    share = (F.col(column).cast("double") - F.col("__lo")) / (F.col("__hi").cast("double") - F.col("__lo"))
    bucket = F.when(F.col("__hi") > F.col("__lo"), F.least(F.floor(share * buckets), F.lit(buckets - 1))).otherwise(F.lit(0)).cast("int")
    own = own.join(ends, by).select(*by, column, "c", bucket.alias("bucket"))
    group, along = Window.partitionBy(*by), Window.partitionBy(*by).orderBy("bucket")
    sums = own.groupBy(*by, "bucket").agg(F.sum("c").alias("n")).withColumn("before", F.sum("n").over(along) - F.col("n")).withColumn("m", F.sum("n").over(group))
    places = F.array(*(F.struct(F.lit(name).alias("name"), F.least(F.col("m") - 1, F.floor(F.lit(q) * F.col("m"))).alias("place")) for name, q in PERCENTILES))
    wanted = sums.select(*by, "bucket", "n", "before", F.explode(places).alias("x")).where("x.place >= before AND x.place < before + n").select(*by, "bucket", "x.name", (F.col("x.place") - F.col("before")).alias("place"))
    few = own.join(wanted.select(*by, "bucket").distinct(), [*by, "bucket"], "left_semi")
    few = few.withColumn("upto", F.sum("c").over(Window.partitionBy(*by, "bucket").orderBy(column)))
    return few.join(wanted, [*by, "bucket"]).where("upto > place").groupBy(*by).agg(*(F.min(F.when(F.col("name") == n, F.col(column))).alias(n) for n, _ in PERCENTILES))


def latency_percentiles(requests: DataFrame, by: list[str], approximate: bool = False, buckets: int = 4096) -> DataFrame:
    """Per group: requests, share and mean latency of the good ones, and percentiles of these by nearest rank, which is
    the value at place min(n - 1, floor(p * n)); see nearest_ranks. ``approximate`` reads them off a sketch instead."""
    total = requests.groupBy(*by).agg(
        F.count("*").alias("n"), F.round(F.avg(F.col("ok").cast("double")), 6).alias("ok_rate"),
        F.round(F.avg(F.when(F.col("ok") == 1, F.col("latency"))), 6).alias("mean_latency"), F.max(F.when(F.col("ok") == 0, F.col("at_s"))).alias("last_error_at"),
    )
    good = requests.where("ok = 1")
    if approximate:
        p = good.groupBy(*by).agg(*(F.percentile_approx("latency", q, 10000).alias(n) for n, q in PERCENTILES))
    else:
        p = nearest_ranks(good.select(*by, "latency"), by, "latency", buckets)
    return total.join(p, by, "left")


def tip_lag(heads: DataFrame) -> DataFrame:
    """Endpoints (chain_id, endpoint, head) with the blocks that they are behind the chain's freshest."""
    best = heads.groupBy("chain_id").agg(F.max("head").alias("__best"))  # summed up before it is shuffled, a row for each chain
    return heads.join(best, "chain_id").select(*heads.columns, (F.col("__best") - F.col("head")).alias("lag"))


def throughput(counters: DataFrame, seconds: int = 10, error_threshold: float = 0.5, span: int = 100_000) -> DataFrame:
    """Cumulative counters (at_s, rows, bytes, errors) as rates per bucket of ``seconds``, flagged where the error rate
    first passes the threshold and where the row rate peaks.

    Buckets are looked at in spans of ``span``, so that a long series is many tasks; of the span before, the last is enough.
    """
    names = ("rows", "bytes", "errors")
    b = counters.groupBy(F.floor(F.col("at_s") / seconds).cast("long").alias("bucket")).agg(*(F.max(c).alias(c) for c in names))
    b = b.withColumn("span", F.floor(F.col("bucket") / span))
    last = b.groupBy("span").agg(F.max_by(F.struct(*names), "bucket").alias("x")).withColumn("before", F.lag("x").over(Window.orderBy("span")))  # one row a span
    w = Window.partitionBy("span").orderBy("bucket")
    b = b.withColumn("own", F.lag(F.struct(*names)).over(w)).join(last.select("span", "before"), "span")
    for c in names:
        earlier = F.when(F.col("own").isNotNull(), F.col(f"own.{c}")).otherwise(F.col(f"before.{c}"))
        b = b.withColumn(f"d_{c}", F.col(c) - F.coalesce(earlier, F.lit(0)))
    b = b.select(
        "bucket",
        F.round(F.col("d_rows") / seconds, 6).alias("rows_per_s"),
        F.round(F.col("d_bytes") / seconds / 1e6, 6).alias("mb_per_s"),
        F.round(F.col("d_errors") / seconds, 6).alias("errors_per_s"),
    )
    s = b.agg(F.min(F.when(F.col("errors_per_s") > error_threshold, F.col("bucket"))).alias("f"), F.min_by("bucket", F.struct(-F.col("rows_per_s"), F.col("bucket"))).alias("p"))
    return b.crossJoin(F.broadcast(s)).select(
        "bucket", "rows_per_s", "mb_per_s", "errors_per_s",
        F.coalesce(F.col("bucket") == F.col("f"), F.lit(False)).alias("first_over_errors"), (F.col("bucket") == F.col("p")).alias("peak"),
    )


def dataset_rates(metrics: DataFrame, cost_per_million: float = 10.0) -> DataFrame:
    """Per data set (dataset, requests, blocks, seconds, bytes, errors) its rates, and a grand total as ``total``."""
    s = metrics.rollup("dataset").agg(*(F.sum(c).alias(c) for c in ("requests", "blocks", "seconds", "bytes", "errors")), F.grouping("dataset").alias("g"))
    return s.select(
        F.when(F.col("g") == 1, "total").otherwise(F.col("dataset")).alias("dataset"),
        "requests", "blocks", "errors",
        F.round(F.col("requests") * 1000.0 / F.col("blocks"), 3).alias("requests_per_1000_blocks"),
        F.round(F.col("blocks") / F.col("seconds").cast("double"), 3).alias("blocks_per_s"),
        F.round(F.col("bytes") / 1048576.0, 3).alias("mib"),
        F.round(F.col("requests") * cost_per_million / 1e6, 6).alias("cost"),
    )


def gate_check(metrics: DataFrame, bounds: DataFrame) -> DataFrame:
    """Metrics (name, value) against bounds (name, at_least, at_most): verdict each, and of all as ``overall``. A bound
    without its metric fails."""
    j = bounds.join(metrics, "name", "left")
    ok = F.col("value").isNotNull() & (F.col("at_least").isNull() | (F.col("value") >= F.col("at_least"))) & (F.col("at_most").isNull() | (F.col("value") <= F.col("at_most")))
    each = j.select("name", "value", F.when(ok, "PASS").otherwise("FAIL").alias("verdict"))
    overall = each.agg(F.when(F.coalesce(F.bool_and(F.col("verdict") == "PASS"), F.lit(False)), "PASS").otherwise("FAIL").alias("verdict"))
    return each.unionByName(overall.select(F.lit("overall").alias("name"), F.lit(None).cast(each.schema["value"].dataType).alias("value"), "verdict"))


def trailing_rate(events: DataFrame, now: int, span: int = 3600, most: int = 3) -> DataFrame:
    """Per source (source, at_s): events, the last, those in the trailing ``span``, flagged if over ``most``."""
    recent = F.count_if((F.col("at_s") > now - span) & (F.col("at_s") <= now))
    return events.groupBy("source").agg(F.count("*").alias("n"), F.max("at_s").alias("last_at"), recent.alias("recent")).withColumn("flagged", F.col("recent") > most)


def window_completeness(windows: DataFrame, indexed: DataFrame, truth: DataFrame, width: int = 1000) -> DataFrame:
    """Windows (chain_id, lo, hi) with both tables' rows in them and whether these are equal.

    Both tables are counted per block in one aggregation. Windows are cut at multiples of ``width`` blocks: a piece that
    is a whole bucket meets the bucket's sum, and only the pieces at a window's ends meet single blocks, of their own
    bucket. So windows of any length join on chain and bucket.
    """
    keys, edge = ["chain_id", "lo", "hi"], ["chain_id", "bucket"]
    both = indexed.select("chain_id", "block_number", F.lit(1).alias("i"), F.lit(0).alias("t")).unionByName(truth.select("chain_id", "block_number", F.lit(0).alias("i"), F.lit(1).alias("t")))
    blocks = both.groupBy("chain_id", "block_number").agg(F.sum("i").alias("i"), F.sum("t").alias("t")).withColumn("bucket", F.floor(F.col("block_number") / width))
    sums = blocks.groupBy(*edge).agg(F.sum("i").alias("i"), F.sum("t").alias("t"))
    pieces = windows.select(*keys).distinct().where("lo <= hi").withColumn("bucket", F.explode(F.sequence(F.floor(F.col("lo") / width), F.floor(F.col("hi") / width))))
    whole = (F.col("lo") <= F.col("bucket") * width) & (F.col("hi") >= F.col("bucket") * width + width - 1)
    found = pieces.where(whole).join(sums, edge).unionByName(pieces.where(~whole).join(blocks, edge).where("block_number BETWEEN lo AND hi").drop("block_number"))
    counts = found.groupBy(*keys).agg(F.sum("i").alias("i"), F.sum("t").alias("t"))
    a, b = F.coalesce("i", F.lit(0)).cast("long"), F.coalesce("t", F.lit(0)).cast("long")
    return windows.join(counts, keys, "left").select(*keys, a.alias("indexed"), b.alias("truth"), (a == b).alias("complete"))


def child_coverage_vs_reference(children: DataFrame, reference: DataFrame, heads: DataFrame, events: DataFrame) -> DataFrame:
    """(chain_id, class, n): reference children (chain_id, child, created_block) as found, after-head, event-less or
    missing, and discovered ones that the reference lacks as extra."""
    keys = ["chain_id", "child"]
    j = (
        reference.join(children.select(*keys, F.lit(True).alias("found")), keys, "left")
        .join(heads.select("chain_id", "finalized"), "chain_id", "left")
        .join(events.select("chain_id", F.col("address").alias("child")).distinct().withColumn("active", F.lit(True)), keys, "left")
    )
    kind = F.when(F.col("found"), "found").when(F.col("created_block") > F.col("finalized"), "after-head").when(F.col("active").isNull(), "event-less").otherwise("missing")
    extra = children.join(reference.select(*keys), keys, "left_anti").select("chain_id", F.lit("extra").alias("class"))
    return j.select("chain_id", kind.alias("class")).unionByName(extra).groupBy("chain_id", "class").agg(F.count("*").alias("n"))
