"""Joins: parents of kept rows, call trees, factory discovery, as-of and enrichment."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from chainframe.functions.encodings import child_at, log_topic
from chainframe.operators.filters import child_logs, configured, match_logs_factory, prepared
from chainframe.scratch import settled

BLOCK, TX = ["chain_id", "block_number"], ["chain_id", "block_number", "transaction_index"]


def parent_transactions(txs: DataFrame, kept_logs: DataFrame) -> DataFrame:
    """Transactions that kept logs refer to, one row per hash."""
    keys = ["chain_id", "tx_hash"]
    return txs.join(kept_logs.select(*keys), keys, "left_semi").select(*txs.columns).dropDuplicates(keys)


def event_blocks(headers: DataFrame, *parts: DataFrame) -> DataFrame:
    """Headers of the blocks that any of ``parts`` (kept logs, interval blocks, transactions) has rows of."""
    wanted = parts[0].select(*BLOCK)
    for p in parts[1:]:
        wanted = wanted.unionByName(p.select(*BLOCK))
    return headers.join(wanted, BLOCK, "left_semi").select(*headers.columns)


def receipts_for(receipts: DataFrame, log_txs: DataFrame | None, transactions: DataFrame | None, trace_txs: DataFrame | None) -> DataFrame:
    """Receipts, one per hash: of logs' transactions if a log source wants receipts, of matched transactions always, of
    traces' transactions if a trace or transfer source wants them. A branch that isn't wanted is None."""
    keys = ["chain_id", "tx_hash"]
    wanted = [p.select(*keys) for p in (log_txs, transactions, trace_txs) if p is not None]
    if not wanted:
        return receipts.limit(0)
    out = wanted[0]
    for p in wanted[1:]:
        out = out.unionByName(p)
    return receipts.join(out, keys, "left_semi").select(*receipts.columns).dropDuplicates(keys)


def trace_transactions(frames: DataFrame, txs: DataFrame) -> DataFrame:
    """Frames with their transaction's hash; where it is missing, the index alone."""
    return frames.join(txs.select(*TX, "tx_hash"), TX, "left").select(*frames.columns, "tx_hash")


def root_gas_override(frames: DataFrame, txs: DataFrame) -> DataFrame:
    """A root frame's gas is its transaction's, if present."""
    j = frames.join(txs.select(*TX, F.col("gas").alias("__gas")), TX, "left")
    gas = F.when(F.size("path") == 0, F.coalesce("__gas", "gas")).otherwise(F.col("gas"))
    return j.select(*(gas.alias("gas") if c == "gas" else F.col(c) for c in frames.columns))


def cascade_errors(frames: DataFrame, step: int = 8) -> DataFrame:
    """Frames (chain_id, block_number, transaction_index, path, error, reason) with errors inherited down the tree.

    A frame without an error takes its nearest ancestor's, and the reason with it, if all frames between are present; its
    own error wins. In the order of paths the last frame of a depth before a frame is its ancestor, if that is present at
    all: so frames of depth ``step`` at most are settled by a window over their transaction, which ranked frames are dealt by
    already, and written once. Only if some are deeper are trees joined; see _deep_errors.
    """
    before = Window.partitionBy(*TX).orderBy("path", "error", "reason").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    last = {f"__at_{d}": F.last(F.when(F.size("path") == d, F.struct("path", "error", "reason")), True).over(before) for d in range(step)}
    from_above = F.lit(None).cast(frames.select(F.struct("error", "reason").alias("e")).schema["e"].dataType)
    for d in range(step):
        above, at = F.size("path") > d, F.col(f"__at_{d}")
        said = F.when(above & at["error"].isNotNull(), F.struct(at["error"].alias("error"), at["reason"].alias("reason")))
        from_above = F.when(above & ~at["path"].eqNullSafe(F.slice("path", 1, d)), None).otherwise(F.coalesce(said, from_above))
    own = settled(frames.withColumns(last).select(*frames.columns, from_above.alias("__above")))
    if own.where(F.size("path") > step).isEmpty():
        j = own.withColumns({"i_error": F.col("__above.error"), "i_reason": F.col("__above.reason")})
    else:
        own = own.drop("__above")
        j = own.join(_deep_errors(own, step), [*TX, "path"], "left")
    new = {"error": F.coalesce("error", "i_error"), "reason": F.when(F.col("error").isNotNull(), F.col("reason")).otherwise(F.coalesce("i_reason", "reason"))}
    return j.select(*(new[c].alias(c) if c in new else F.col(c) for c in frames.columns))


def _deep_errors(frames: DataFrame, step: int) -> DataFrame:
    """(TX, path, i_error, i_reason): what frames of trees of any depth inherit.

    Only transactions with an error are looked into. A frame is joined with its ``step`` nearest ancestors
    at most; one that they don't settle points to the farthest of them, and pointers are doubled until none is left. So a
    tree of any depth costs ``step`` rows a frame, and a join for each doubling of its depth beyond that.
    """
    failing = frames.where("error IS NOT NULL").select(*TX).distinct()
    inside = settled(frames.join(failing, TX, "left_semi").select(*TX, "path", "error", "reason"))
    depth = F.size("path")
    ancestors = (
        inside.where("error IS NULL AND size(path) > 0")
        .select(*TX, F.col("path").alias("frame"), F.explode(F.sequence(F.greatest(depth - step, F.lit(0)), depth - 1)).alias("depth"))
        .withColumn("path", F.slice("frame", 1, F.col("depth")))
    )
    known = inside.select(*TX, "path", F.col("error").alias("a_error"), F.col("reason").alias("a_reason"), F.lit(True).alias("present"))
    nearest = ancestors.join(known, [*TX, "path"], "left").groupBy(*TX, "frame").agg(
        F.max(F.when(F.col("a_error").isNotNull(), F.struct("depth", "a_error", "a_reason"))).alias("found"),
        F.max(F.when(F.col("present").isNull(), F.col("depth"))).alias("hole"),
    )
    reached = F.col("found").isNotNull() & (F.col("hole").isNull() | (F.col("hole") < F.col("found.depth")))
    above = F.when(F.col("found").isNull() & F.col("hole").isNull() & (F.size("frame") > step), F.slice("frame", 1, F.size("frame") - step))
    state = nearest.select(
        *TX, "frame", F.when(reached, F.col("found.a_error")).alias("i_error"), F.when(reached, F.col("found.a_reason")).alias("i_reason"), above.alias("up")
    )
    state = settled(state)
    while not state.where("up IS NOT NULL").isEmpty():
        said = state.select(*TX, F.col("frame").alias("up"), F.col("i_error").alias("u_error"), F.col("i_reason").alias("u_reason"), F.col("up").alias("u_up"))
        moved = state.where("up IS NOT NULL").join(said, [*TX, "up"], "left")
        moved = moved.select(*TX, "frame", F.col("u_error").alias("i_error"), F.col("u_reason").alias("i_reason"), F.col("u_up").alias("up"))
        state = settled(state.where("up IS NULL").unionByName(moved))
    return state.where("i_error IS NOT NULL").select(*TX, F.col("frame").alias("path"), "i_error", "i_reason")


def discover_children(logs: DataFrame, factories: DataFrame, location: str = "topic1") -> DataFrame:
    """(factory_id, chain_id, child, created_block): first creations by factories (factory_id, chain_id, address, topic0,
    from_block, to_block, and location of the child). A null address or bound is any; topic0 is needed, so a row without
    matches nothing. A factory may have several rows, each on its own. Creations outside a row's range are ignored.

    ``address`` may be one value or a list. Factories without a location of their own have ``location``: ``topicN``, or
    ``offsetN``, the byte where a word of the data begins.
    """
    # rows are told apart by all that they say: one factory may have several addresses, topics and locations
    own = factories.withColumn("filter_id", F.to_json(F.struct(*factories.columns)))
    place = F.coalesce(F.col("location") if "location" in factories.columns else F.lit(None).cast("string"), F.lit(location))
    f = prepared(own, ("address",), ()).drop("address_factory")
    kinds = own.select("filter_id", "chain_id", F.col("factory_id").cast("string").alias("factory_id"), F.lower("topic0").alias("topic0"), place.alias("location"))
    f = f.join(kinds.distinct(), ["filter_id", "chain_id"])
    f = f.select(*(F.col(c).alias(f"f_{c}") for c in ("factory_id", "chain_id", "address", "topic0", "from_block", "to_block", "location")))
    f = configured(f)
    match = (
        (F.col("f_chain_id") == F.col("chain_id")) & (F.col("f_topic0") == F.lower(log_topic(logs, 0)))
        & (F.col("f_address").isNull() | F.array_contains("f_address", F.lower("address")))
        & (F.col("f_from_block").isNull() | (F.col("block_number") >= F.col("f_from_block")))
        & (F.col("f_to_block").isNull() | (F.col("block_number") <= F.col("f_to_block")))
    )
    created = logs.join(f, match).withColumn("factory_id", F.col("f_factory_id"))
    found = created.select("factory_id", "chain_id", "block_number", child_at(created, F.col("f_location")).alias("child"))
    return found.where("child IS NOT NULL").groupBy("factory_id", "chain_id", "child").agg(F.min("block_number").alias("created_block"))


def child_events(logs: DataFrame, children: DataFrame) -> DataFrame:
    """Logs of ``children`` (of discover_children) from their creation on, whichever factory made them."""
    return child_logs(logs, children.groupBy("chain_id", "child").agg(F.min("created_block").alias("created_block")))


def factory_events(logs: DataFrame, factories: DataFrame, filters: DataFrame | None = None, location: str = "topic1") -> DataFrame:
    """Logs of contracts that factories created, from their creation on: discovery over all logs, then the match.

    With ``filters`` (address_factory, topics, range) a log must come from a child of the filter's own factory; without,
    all logs of all children are taken.
    """
    children = discover_children(logs, factories, location)
    return child_events(logs, children) if filters is None else match_logs_factory(logs, filters, children)


def dedupe_children_least(children: DataFrame, persisted: DataFrame) -> DataFrame:
    """Children (factory, chain_id, address, created_block) to write: unknown ones, or known ones found strictly earlier.
    Addresses compare without case; factories by value."""
    keys = ["factory", "chain_id", "address"]

    def least(df: DataFrame, name: str) -> DataFrame:
        return df.withColumn("factory", F.lower("factory")).withColumn("address", F.lower("address")).groupBy(*keys).agg(F.min("created_block").alias(name))

    j = least(children, "created_block").join(least(persisted, "known"), keys, "left")
    return j.where("known IS NULL OR created_block < known").select(*keys, "created_block")


def children_in_range(children: DataFrame, lo: int, hi: int) -> DataFrame:
    """Children whose creation lies in the interval."""
    return children.where(F.col("created_block").between(lo, hi))


def asof_block(checkpoints: DataFrame, blocks: DataFrame, seconds: int = 86400) -> DataFrame:
    """Checkpoints (chain_id, checkpoint_ts) with the chain's highest block strictly earlier; null if there is none.

    No range join: both sides are sorted together within spans of ``seconds``, so that a long chain is many tasks, and
    what earlier spans reach is carried over from one row a span.
    """
    span = F.floor(F.col("ts") / seconds)
    a = checkpoints.select("chain_id", F.col("checkpoint_ts").alias("ts"), F.lit(0).alias("kind"), F.struct(*checkpoints.columns).alias("row"), F.lit(None).cast("long").alias("b"))
    b = blocks.select("chain_id", F.col("block_ts").alias("ts"), F.lit(1).alias("kind"), F.lit(None).cast(a.schema["row"].dataType).alias("row"), F.col("block_number").cast("long").alias("b"))
    # at equal times the checkpoint comes first, so that block isn't below it
    inside = Window.partitionBy("chain_id", "span").orderBy("ts", "kind").rowsBetween(Window.unboundedPreceding, -1)
    both = a.unionByName(b).withColumn("span", span)
    earlier = Window.partitionBy("chain_id").orderBy("span").rowsBetween(Window.unboundedPreceding, -1)
    carried = both.groupBy("chain_id", "span").agg(F.max("b").alias("top")).withColumn("carried", F.max("top").over(earlier)).select("chain_id", "span", "carried")
    own = both.withColumn("own", F.max("b").over(inside)).where("kind = 0")
    return own.join(carried, ["chain_id", "span"]).select("row.*", F.greatest("own", "carried").alias("asof_block"))


def relation_pages(one: DataFrame, many: DataFrame, key: list[str], item: list[str], page: Column, to: str = "items") -> DataFrame:
    """Rows of ``one`` by pages of their ``many``: key, page, the array of the page's items, sorted, and its size; a single
    null page where there is none. ``page`` is a bounded part of a key's rows, such as a block bucket: a key with any
    number of rows is many arrays, and no task gathers all of them."""
    got = many.groupBy(*key, page.alias("page")).agg(F.sort_array(F.collect_list(F.struct(*item))).alias(to))
    size = F.coalesce(F.size(to), F.lit(0)).cast("long")
    return one.join(got, key, "left").select(*one.columns, "page", to, F.greatest(size, F.lit(0)).alias(f"n_{to}"))


def relation_join(one: DataFrame, many: DataFrame, key: list[str], item: list[str], to: str = "items", most: int | None = 1000) -> DataFrame:
    """Rows of ``one`` with the array of the first ``most`` of their ``many``, sorted, and how many there are; empty where
    there is none. All items of a key without bound, for keys that are known to have few, with None; see relation_pages
    for keys with many."""
    if most is None:
        size = F.count("*")
    else:  # no more than ``most`` items of a key are gathered
        n = many.groupBy(*key).agg(F.count("*").alias("__size"))
        rank = F.row_number().over(Window.partitionBy(*key).orderBy(*item))
        many = many.withColumn("__n", rank).where(F.col("__n") <= most).join(n, key)
        size = F.first("__size")
    got = many.groupBy(*key).agg(F.sort_array(F.collect_list(F.struct(*item))).alias(to), size.alias("__size"))
    size = F.coalesce("__size", F.lit(0)).cast("long")
    return one.join(got, key, "left").select(*one.columns, F.col(to), size.alias(f"n_{to}"))


def ensure_parent(creations: DataFrame, actions: DataFrame, key: list[str], meta: list[str]) -> DataFrame:
    """Parents from creations (key, block_number, meta) and from first actions (key, block_number): an action on an unseen
    parent makes one with null metadata at its block; a creation that isn't later wins."""
    first = actions.groupBy(*key).agg(F.min("block_number").alias("a_block"))
    c = creations.groupBy(*key).agg(F.min_by(F.struct("block_number", *meta), "block_number").alias("c"))
    j = c.join(first, key, "full_outer")
    created = F.col("c.block_number").isNotNull() & (F.col("a_block").isNull() | (F.col("c.block_number") <= F.col("a_block")))
    return j.select(
        *key,
        F.when(created, F.col("c.block_number")).otherwise(F.col("a_block")).alias("block_number"),
        *(F.when(created, F.col(f"c.{m}")).alias(m) for m in meta),
        (~created).alias("stub"),
    )


def enrich_metadata(df: DataFrame, metadata: DataFrame, key: list[str]) -> DataFrame:
    """``df`` with the metadata that is there; rows stay without."""
    return df.join(metadata.dropDuplicates(key), key, "left")


def label_events(logs: DataFrame, labels: DataFrame) -> DataFrame:
    """Logs with their label (by topic0), or ``other``."""
    return logs.join(labels.select("topic0", "label"), "topic0", "left").select(*logs.columns, F.coalesce("label", F.lit("other")).alias("label"))


def logs_equal_truth(logs: DataFrame, truth: DataFrame, keys: list[str], columns: list[str]) -> DataFrame:
    """Differences (keys, kind, fields): MISSING (only in the truth), EXTRA, or MISMATCH with the differing fields."""
    a = logs.select(*keys, F.struct(*columns).alias("a"))
    b = truth.select(*keys, F.struct(*columns).alias("b"))
    fields = F.array_compact(F.array(*(F.when(~F.col(f"a.{c}").eqNullSafe(F.col(f"b.{c}")), F.lit(c)) for c in columns)))
    j = a.join(b, keys, "full_outer").select(
        *keys,
        F.when(F.col("a").isNull(), "MISSING").when(F.col("b").isNull(), "EXTRA").when(F.size(fields) > 0, "MISMATCH").alias("kind"),
        F.when(F.col("a").isNotNull() & F.col("b").isNotNull(), F.array_join(fields, ",")).otherwise("").alias("fields"),
    )
    return j.where("kind IS NOT NULL")
