"""Source filters as tables: rows match if any filter does. Nothing is duplicated and no column is added.

A filter's null means any. An address, a topic, a selector or a call type may be one value or a list of values; an address
may also be a factory: then contracts that it created match, from their creation on (``children``: factory_id, chain_id,
child, created_block). Filters are told apart by ``filter_id`` where sides of one filter must meet.

Filters are a source's configuration: their lists are spread to rows, so that each kind of filter has an equi key beside the
chain, and sent to all tasks if they have MOST_SENT entries at most (beyond that Catalyst chooses). Rows meet them in one scan,
without a shuffle. Children of factories are settled in a table first. Up to MOST_SENT of them are sent, too. If there are
more, only rows that may be of a child, by a bitmap of bounded size over all children, and that no filter without a factory
takes already, are shuffled to look up whose children they are, once for each side that has factories; hot addresses are a
left join's left side, which Spark splits. The blocks that all filters
together want bound the scan, and with ``partitions`` of the store it reads only those of the ranges of filters.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from chainframe.operators import probes
from chainframe.scratch import settled
from chainframe.sources.blocks import scan_windows

RANGE = "(f.from_block IS NULL OR r.block_number >= f.from_block) AND (f.to_block IS NULL OR r.block_number <= f.to_block)"
#: Rows within the blocks that any filter wants.
WANTED = """r.block_number >= (SELECT min(coalesce(from_block, 0)) FROM {filters})
  AND r.block_number <= (SELECT max(coalesce(to_block, 9223372036854775807)) FROM {filters})"""
#: Entries of filters, values in lists included, and children of their factories that are sent to all tasks.
MOST_SENT = 100_000
#: Rows that look up nothing are dealt out by so many salts.
SALTS = 64


def _values(df: DataFrame, name: str) -> Column:
    """A filter's column as a list in lower case; null is any, and so is a column that isn't there."""
    if name not in df.columns:
        return F.lit(None).cast("array<string>")
    one = df.schema[name].dataType.simpleString()
    c = F.col(name) if one.startswith("array") else F.when(F.col(name).isNotNull(), F.array(F.col(name).cast("string")))
    return F.transform(c, lambda x: F.lower(x))


def _plain(df: DataFrame, name: str, kind: str) -> Column:
    return F.col(name).cast(kind) if name in df.columns else F.lit(None).cast(kind)


def prepared(filters: DataFrame, sides: tuple[str, ...], sets: tuple[str, ...]) -> DataFrame:
    """Filters with an id, the lists of ``sides`` and ``sets``, the factories of ``sides`` and the range."""
    ids = F.col("filter_id").cast("string") if "filter_id" in filters.columns else F.sha2(F.to_json(F.struct("*")), 256)
    factories = [_plain(filters, f"{s}_factory", "string").alias(f"{s}_factory") for s in sides]
    return filters.select(
        ids.alias("filter_id"), F.col("chain_id"), *(_values(filters, c).alias(c) for c in (*sides, *sets)), *factories,
        _plain(filters, "from_block", "long").alias("from_block"), _plain(filters, "to_block", "long").alias("to_block"),
        F.coalesce(_plain(filters, "include_reverted", "boolean"), F.lit(True)).alias("include_reverted"),
    )


def _in(row: str, name: str) -> str:
    """The row's value is in the filter's list, if it has one."""
    return f"(f.{name} IS NULL OR array_contains(f.{name}, lower({row})))"


def _topic(logs: DataFrame, k: int) -> str:
    """A log's topic: from ``topicK`` or from the list ``topics``; null beyond its end."""
    return f"r.topic{k}" if f"topic{k}" in logs.columns else f"get(r.topics, {k})" if "topics" in logs.columns else "CAST(NULL AS STRING)"


def _kinds(f: DataFrame, keys: dict[str, str], sent: bool, match_all: bool) -> tuple[list[str], dict[str, DataFrame]]:
    """(join conditions, filters) by kind: those with a list for the first of ``keys`` (name -> the row's value), spread on
    it; of the others those with one for the next; and those without any."""
    conditions, tables = [], {}
    for name, row in keys.items():
        tables[f"by_{name}"] = f.where(F.col(name).isNotNull()).withColumn("own_key", F.explode(name))
        conditions.append(f"f.own_key = lower({row})")
        f = f.where(F.col(name).isNull())
    if match_all:
        tables["by_none"] = f
        conditions.append("true")
    return conditions, {n: F.broadcast(t) if sent else t for n, t in tables.items()}


def _any_filter(rows: DataFrame, f: DataFrame, keys: dict[str, str], rest: str, sent: bool, match_all: bool, prefix: str) -> tuple[str, dict[str, DataFrame]]:
    """SQL of whether any filter takes the row ``r``, and the tables that it names."""
    conditions, tables = _kinds(f, keys, sent, match_all)
    named = {f"{prefix}_{n}": t for n, t in tables.items()}
    parts = [f"EXISTS (SELECT 1 FROM {{{n}}} f WHERE f.chain_id = r.chain_id AND {c} AND {rest} AND {RANGE})" for c, n in zip(conditions, named)]
    return f"({' OR '.join(parts)})", named


def _matching(rows: DataFrame, f: DataFrame, children: DataFrame | None, sides: dict[str, str], more: dict[str, str], rest: str, match_all: bool, partitions: DataFrame | None) -> DataFrame:
    """Rows that any of the prepared filters takes. ``sides`` (name -> the row's address) may be factories; ``more`` are
    other keys; ``rest`` is SQL that must hold besides; without ``match_all`` filters that fix no side are skipped."""
    spark, columns = rows.sparkSession, rows.columns
    lists = [c for c in f.columns if f.schema[c].dataType.simpleString() == "array<string>"]
    entries = sum((F.greatest(F.size(c), F.lit(0)) for c in lists), F.lit(1))
    facts = f.agg(F.coalesce(F.sum(entries), F.lit(0)).alias("n"), *(F.count(f"{s}_factory").alias(s) for s in sides)).first()  # a look at the configuration
    if sent := facts["n"] <= MOST_SENT:
        f = spark.createDataFrame(f.collect(), f.schema)  # read once for all kinds, as it is small
    made = [s for s in sides if facts[s]] if children is not None else []
    if partitions is not None:
        rows = scan_windows(rows, f.select("chain_id", F.col("from_block").alias("lo"), F.col("to_block").alias("hi")), partitions)
    if not match_all:
        f = f.where(" OR ".join(f"{s} IS NOT NULL OR {s}_factory IS NOT NULL" for s in sides))
    of_lists = " AND ".join(_in(row, s) for s, row in sides.items()) + f" AND {rest}"
    keys = sides | more
    plain, tables = _any_filter(rows, f.where(" AND ".join(f"{s}_factory IS NULL" for s in sides)), keys, of_lists, sent, match_all or bool(more), "plain")
    if not made:
        return spark.sql(f"SELECT r.* FROM {{rows}} r WHERE {WANTED} AND {plain}", rows=rows, filters=f, **tables)

    of = _makers(children, f, made)
    few = _few(of)
    own = spark.sql(f"SELECT r.*, {plain} AS __taken FROM {{rows}} r WHERE {WANTED}", rows=rows, filters=f, **tables)
    if few:
        own = own.withColumnRenamed("__taken", "__plain")
        for s in made:
            own = _looked_up(own, of, f"lower({sides[s]})".replace("r.", ""), s, F.broadcast)
    else:
        own = own.select(*columns, F.explode(F.array("__taken")).alias("__plain"))  # else a condition on it would look it up again
        bits = settled(probes.bitmap(of.select(F.expr(probes.key_hash("__chain", "__child")).alias("h"))))
        may = {s: probes.seen("bits", probes.key_hash("r.chain_id", f"lower({sides[s]})")) for s in made}
        asked = ", ".join(f"CASE WHEN NOT r.__plain AND {may[s]} THEN lower({sides[s]}) END AS __ask_{s}" for s in made)
        own = spark.sql(f"SELECT r.*, {asked} FROM {{own}} r WHERE r.__plain OR {' OR '.join(may.values())}", own=own, bits=bits)
        for s in made:
            own = _looked_up(own, of, f"__ask_{s}", s, lambda t: t)
    of_factories = " AND ".join(
        f"(f.{s}_factory IS NULL OR r.__by_{s}[f.{s}_factory] <= r.block_number)" if s in made else f"f.{s}_factory IS NULL" for s in sides
    )
    by_factory, tables = _any_filter(own, f.where(" OR ".join(f"{s}_factory IS NOT NULL" for s in sides)), keys, f"{of_lists} AND {of_factories}", sent, True, "made")
    own = own.where(" OR ".join(["__plain", *(f"__by_{s} IS NOT NULL" for s in made)]))
    return spark.sql(f"SELECT r.* FROM {{own}} r WHERE r.__plain OR {by_factory}", own=own, **tables).select(*columns)


def configured(f: DataFrame) -> DataFrame:
    """A configuration's rows, which are read once and sent to all tasks if they are MOST_SENT at most; else as they are."""
    got = f.limit(MOST_SENT + 1).collect()
    return F.broadcast(f.sparkSession.createDataFrame(got, f.schema)) if len(got) <= MOST_SENT else f


def _few(table: DataFrame) -> bool:
    """Whether a table that was just written may be sent to all tasks; its files know their rows."""
    return table.count() <= MOST_SENT


def _makers(children: DataFrame, f: DataFrame, sides: list[str]) -> DataFrame:
    """(__chain, __child, __by): addresses with the filters' factories that made them, mapped to the block; a child has as many as
    the configuration names. Written, as each side and the bitmap read it."""
    used = f.select(F.explode(F.array(*(f"{s}_factory" for s in sides))).alias("factory_id")).where("factory_id IS NOT NULL").distinct()
    c = children.select(F.col("factory_id").cast("string").alias("factory_id"), F.col("chain_id").cast("long").alias("__chain"), F.lower("child").alias("__child"), F.col("created_block").cast("long").alias("since"))
    own = c.join(used, "factory_id", "left_semi").repartition("__chain", "__child")  # both aggregations stay where this puts them
    least = own.groupBy("__chain", "__child", "factory_id").agg(F.min("since").alias("since"))
    return settled(least.groupBy("__chain", "__child").agg(F.map_from_entries(F.collect_list(F.struct("factory_id", "since"))).alias("__by")))


def _looked_up(own: DataFrame, of: DataFrame, ask: str, side: str, hint) -> DataFrame:
    """``own`` with __by_SIDE, the makers of the address ``ask``. Rows that ask nothing are dealt out by salts."""
    known = [c for c in ("block_number", "transaction_index", "log_index", "trace_index") if c in own.columns]
    salt = F.when(F.expr(ask).isNull(), F.pmod(F.xxhash64(*known), F.lit(SALTS))).otherwise(F.lit(0))
    of = of.select(F.col("__chain").alias(f"__chain_{side}"), F.col("__child").alias(f"__child_{side}"), F.lit(0).cast("long").alias(f"__zero_{side}"), F.col("__by").alias(f"__by_{side}"))
    same = (F.col("chain_id").cast("long") == F.col(f"__chain_{side}")) & (F.expr(ask) == F.col(f"__child_{side}")) & (salt == F.col(f"__zero_{side}"))
    return own.join(hint(of), same, "left")


def match_logs(logs: DataFrame, filters: DataFrame, children: DataFrame | None = None, partitions: DataFrame | None = None) -> DataFrame:
    """Logs that a log filter (chain_id, address or address_factory, topic0 .. topic3, from_block, to_block) matches.

    A filter by factory takes logs of its children from their creation on; without children it matches nothing.
    ``partitions`` (chain_id, block_bucket) are those of the store that ``logs`` are read from: others than the filters' are
    not read.
    """
    f = prepared(filters, ("address",), ("topic0", "topic1", "topic2", "topic3"))
    topics = " AND ".join(_in(_topic(logs, k), f"topic{k}") for k in range(4))
    return _matching(logs, f, children, {"address": "r.address"}, {"topic0": _topic(logs, 0)}, topics, True, partitions)


def match_logs_factory(logs: DataFrame, filters: DataFrame, children: DataFrame, partitions: DataFrame | None = None) -> DataFrame:
    """Logs of factory children that a filter (chain_id, address_factory, topic0 .. topic3, from_block, to_block) matches:
    children of its own factory, from their creation on. No children match nothing; filters without a factory are left out."""
    return match_logs(logs, filters.where("address_factory IS NOT NULL"), children, partitions)


def child_logs(logs: DataFrame, children: DataFrame) -> DataFrame:
    """All logs of children (chain_id, child, created_block), whatever their factory, from their creation on."""
    same = (F.col("r.chain_id") == F.col("c.chain_id")) & (F.col("r.address") == F.col("c.child"))
    return logs.alias("r").join(children.alias("c"), same & (F.col("r.block_number") >= F.col("c.created_block")), "left_semi")


SIDES = {"from_address": "r.from_address", "to_address": "r.to_address"}


def match_transactions(txs: DataFrame, filters: DataFrame, children: DataFrame | None = None, partitions: DataFrame | None = None) -> DataFrame:
    """Transactions that a filter (chain_id, from_address or from_address_factory, to_address or to_address_factory,
    from_block, to_block) matches.

    Both sides of one filter must hold; filters that fix neither are skipped; a null recipient matches no recipient.
    """
    return _matching(txs, prepared(filters, ("from_address", "to_address"), ()), children, SIDES, {}, "true", False, partitions)


def drop_reverted(txs: DataFrame, receipts: DataFrame) -> DataFrame:
    """Transactions whose receipt says success."""
    keys = ["chain_id", "block_number", "transaction_index"]
    return txs.join(receipts.where("status = 1").select(*keys), keys, "left_semi").select(*txs.columns)


def match_traces(ranked: DataFrame, filters: DataFrame, children: DataFrame | None = None, partitions: DataFrame | None = None) -> DataFrame:
    """Frames that a filter (as for match_transactions, with selector, call_type and include_reverted) matches; a filter
    that fixes nothing takes all of its chain's frames.

    ``ranked`` frames (from_address, to_address, selector, call_type, and error if reverted ones are to be told) already
    have their trace_index: a frame's rank counts frames that no filter wants.
    """
    f = prepared(filters, ("from_address", "to_address"), ("selector", "call_type"))
    reverted = " AND (f.include_reverted OR r.error IS NULL)" if "error" in ranked.columns else ""
    rest = f"{_in('r.selector', 'selector')} AND {_in('r.call_type', 'call_type')}{reverted}"
    return _matching(ranked, f, children, SIDES, {}, rest, True, partitions)


def match_transfers(ranked: DataFrame, filters: DataFrame, children: DataFrame | None = None, value: str = "value_hex") -> DataFrame:
    """Frames that move value (over zero) and that a filter (as for match_traces) matches."""
    return match_traces(ranked.where(~F.regexp_replace(F.col(value), "^0x", "").rlike("^0*$")), filters, children)


def match_blocks_interval(blocks: DataFrame, filters: DataFrame) -> DataFrame:
    """Blocks that an interval filter (chain_id, interval, offset, from_block, to_block) picks."""
    return blocks.sparkSession.sql(
        f"""SELECT r.* FROM {{blocks}} r LEFT SEMI JOIN {{filters}} f
            ON f.chain_id = r.chain_id AND (r.block_number - f.offset) % f.interval = 0 AND {RANGE}""",
        blocks=blocks,
        filters=filters,
    )


def trim_superset(logs: DataFrame, txs: DataFrame, children: DataFrame, discovery: DataFrame) -> tuple[DataFrame, DataFrame]:
    """A scan that was widened to topics, trimmed to logs of live children or of discovery (chain_id, block_number,
    log_index); transactions without a kept log go too.

    Children and discovery are settled in tables first. If either has more than MOST_SENT rows, logs that may be of either by
    bitmaps are shuffled to look it up; else nothing is shuffled.
    """
    spark, keys = logs.sparkSession, ["chain_id", "block_number", "log_index"]
    c = children.groupBy(F.col("chain_id").cast("long").alias("__chain"), F.lower("child").alias("__child")).agg(F.min("created_block").alias("__by"))
    d = discovery.select(*(F.col(k).cast("long").alias(f"__{k}") for k in keys)).distinct()
    c, d = settled(c), settled(d)
    few = {"c": _few(c), "d": _few(d)}
    own, ask = logs, "lower(address)"
    if not all(few.values()):
        at = "concat_ws('-', {0}block_number, {0}log_index)".format
        bits = {"of_child": settled(probes.bitmap(c.select(F.expr(probes.key_hash("__chain", "__child")).alias("h")))), "of_discovery": settled(probes.bitmap(d.select(F.expr(probes.key_hash("__chain_id", at("__"))).alias("h"))))}
        may_child, may_discovery = probes.seen("of_child", probes.key_hash("r.chain_id", "lower(r.address)")), probes.seen("of_discovery", probes.key_hash("r.chain_id", at("r.")))
        own = spark.sql(f"SELECT r.*, CASE WHEN {may_child} THEN lower(r.address) END AS __ask FROM {{logs}} r WHERE {may_child} OR {may_discovery}", logs=logs, **bits)
        ask = "__ask"
    own = _looked_up(own, c, ask, "child", F.broadcast if few["c"] else lambda t: t)
    d = F.broadcast(d) if few["d"] else d
    same = (own["chain_id"] == d["__chain_id"]) & (own["block_number"] == d["__block_number"]) & (own["log_index"] == d["__log_index"])
    live = F.coalesce(F.col("__by_child") <= F.col("block_number"), F.lit(False))
    kept = own.join(d, same, "left").where(live | F.col("__block_number").isNotNull()).select(*logs.columns)
    return kept, txs.join(kept.select("chain_id", "tx_hash"), ["chain_id", "tx_hash"], "left_semi").select(*txs.columns)


def exclude_no_tx_frames(frames: DataFrame) -> DataFrame:
    """Frames of a transaction: rewards and frames without one go, before ranking."""
    return frames.where("transaction_index IS NOT NULL AND coalesce(type, '') <> 'reward'")


def event_has_match(blocks: DataFrame, kept_logs: DataFrame, interval_blocks: DataFrame) -> DataFrame:
    """Blocks with ``matched``: whether a log of it was kept or a block filter picks it."""
    keys = ["chain_id", "block_number"]
    hit = kept_logs.select(*keys).unionByName(interval_blocks.select(*keys)).distinct().withColumn("__hit", F.lit(True))
    return blocks.join(hit, keys, "left").select(*blocks.columns, F.coalesce("__hit", F.lit(False)).alias("matched"))
