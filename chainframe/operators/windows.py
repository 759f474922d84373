"""Ranking, interval bookkeeping, progress and reorganisations; ordering, cuts and set operations."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from chainframe.functions.encodings import checkpoint_encode

TX = ["chain_id", "block_number", "transaction_index"]


def rank_traces(frames: DataFrame) -> DataFrame:
    """Add trace_index: the frame's place, from 0, in its transaction's whole tree in pre-order. Arrays compare by their
    first differing element and prefixes come first, so ordering by path is pre-order."""
    return frames.withColumn("trace_index", (F.row_number().over(Window.partitionBy(*TX).orderBy("path")) - 1).cast("long"))


def dedupe_first(parts: list[DataFrame], keys: list[str]) -> DataFrame:
    """One row per key across branches, with the number of the first branch that has it."""
    both = reduce(DataFrame.unionByName, (p.withColumn("branch", F.lit(k)) for k, p in enumerate(parts)))
    w = Window.partitionBy(*keys).orderBy("branch")
    return both.withColumn("__n", F.row_number().over(w)).where("__n = 1").drop("__n")


# --- intervals: half-open [lo, hi) per fragment -----------------------------------------------------------------


#: Blocks of a span: what a task of the interval operators looks at in a fragment.
SPAN = 1_000_000


def coalesce_intervals(intervals: DataFrame, span: int = SPAN) -> DataFrame:
    """(fragment_id, lo, hi) with overlapping and adjacent ranges merged; empty ranges go.

    Two levels, so that a fragment of any length is many tasks: ranges are merged by the ``span`` blocks that they begin in,
    knowing how far earlier spans reach. What of a span goes on with what was before, and the last range of each span, are
    then merged along the fragment, two rows a span. Where all ranges begin in one span, which a look at their least and
    greatest start tells, the first level is all there is.
    """
    s = intervals.where("lo < hi").select("fragment_id", "lo", "hi", F.floor(F.col("lo") / span).alias("span"))
    ends = s.agg(F.min("span").alias("a"), F.max("span").alias("b")).first()
    if ends["a"] == ends["b"]:
        order = Window.partitionBy("fragment_id").orderBy("lo", "hi")
        before = F.max("hi").over(order.rowsBetween(Window.unboundedPreceding, -1))
        own = s.withColumn("new", F.when(before.isNull() | (F.col("lo") > before), 1).otherwise(0))
        own = own.withColumn("island", F.sum("new").over(order.rowsBetween(Window.unboundedPreceding, 0)))
        return own.groupBy("fragment_id", "island").agg(F.min("lo").alias("lo"), F.max("hi").alias("hi")).drop("island")
    earlier = Window.partitionBy("fragment_id").orderBy("span").rowsBetween(Window.unboundedPreceding, -1)
    carried = s.groupBy("fragment_id", "span").agg(F.max("hi").alias("top")).withColumn("carried", F.max("top").over(earlier)).drop("top")
    inside = Window.partitionBy("fragment_id", "span").orderBy("lo", "hi")
    reach = F.greatest("carried", F.max("hi").over(inside.rowsBetween(Window.unboundedPreceding, -1)))
    own = s.join(carried, ["fragment_id", "span"]).withColumn("reach", reach)
    own = own.withColumn("new", F.when(F.col("reach").isNull() | (F.col("lo") > F.col("reach")), 1).otherwise(0))
    own = own.withColumn("island", F.sum("new").over(inside.rowsBetween(Window.unboundedPreceding, 0)))
    local = own.groupBy("fragment_id", "span", "island").agg(F.min("lo").alias("lo"), F.max("hi").alias("hi"))
    local = local.withColumn("last", F.col("island") == F.max("island").over(Window.partitionBy("fragment_id", "span")))
    edges = local.where("last OR island = 0")  # island 0 goes on with the last one before
    along = Window.partitionBy("fragment_id").orderBy("span", "island").rowsBetween(Window.unboundedPreceding, 0)
    edges = edges.withColumn("whole", F.sum(F.when(F.col("island") > 0, 1).otherwise(0)).over(along))
    merged = edges.groupBy("fragment_id", "whole").agg(F.min("lo").alias("lo"), F.max("hi").alias("hi"))
    return local.where("NOT last AND island > 0").select("fragment_id", "lo", "hi").unionByName(merged.select("fragment_id", "lo", "hi"))


def missing_ranges(intervals: DataFrame, wanted: DataFrame, span: int = SPAN) -> DataFrame:
    """What of each fragment's wanted range (fragment_id, want_lo, want_hi) isn't covered; by spans, as for
    coalesce_intervals: where a span's last range ends, the next span's first one is looked up."""
    c = coalesce_intervals(intervals, span).join(wanted, "fragment_id").where("lo < want_hi AND hi > want_lo")
    c = c.select("fragment_id", "want_lo", "want_hi", F.greatest("lo", "want_lo").alias("lo"), F.least("hi", "want_hi").alias("hi")).withColumn("span", F.floor(F.col("lo") / span))
    firsts = c.groupBy("fragment_id", "span").agg(F.min("lo").alias("first"))
    next_span = firsts.withColumn("later", F.lead("first").over(Window.partitionBy("fragment_id").orderBy("span"))).drop("first")
    after = Window.partitionBy("fragment_id", "span").orderBy("lo")
    gaps = c.join(next_span, ["fragment_id", "span"]).select("fragment_id", F.col("hi").alias("lo"), F.coalesce(F.lead("lo").over(after), F.col("later"), F.col("want_hi")).alias("hi"))
    heads = wanted.join(firsts.groupBy("fragment_id").agg(F.min("first").alias("first")), "fragment_id", "left").select(
        "fragment_id", F.col("want_lo").alias("lo"), F.coalesce("first", "want_hi").alias("hi")
    )
    return heads.unionByName(gaps).where("lo < hi")


def contiguous_coverage(intervals: DataFrame, starts: DataFrame) -> DataFrame:
    """Per fragment (fragment_id, want_lo) the block up to which coverage goes on without a gap; want_lo if none."""
    j = starts.join(coalesce_intervals(intervals), "fragment_id", "left")
    inside = (F.col("lo") <= F.col("want_lo")) & (F.col("hi") > F.col("want_lo"))
    return j.groupBy("fragment_id", "want_lo").agg(F.max(F.when(inside, F.col("hi"))).alias("h")).select(
        "fragment_id", "want_lo", F.coalesce("h", "want_lo").alias("covered_to")
    )


def coverage_class(intervals: DataFrame, wanted: DataFrame) -> DataFrame:
    """One row: the least coverage over the wanted fragments, as per cent, and empty, partial or complete. Nothing wanted
    or nothing covered is empty."""
    reach = contiguous_coverage(intervals, wanted.select("fragment_id", "want_lo")).join(wanted, ["fragment_id", "want_lo"])
    part = F.least(F.col("covered_to"), F.col("want_hi")) - F.col("want_lo")
    s = reach.agg(F.count("*").alias("fragments"), F.min(part / (F.col("want_hi") - F.col("want_lo"))).alias("least"), F.max(part).alias("most"))
    kind = F.when((F.col("fragments") == 0) | (F.col("most") <= 0), "empty").when(F.col("least") >= 1, "complete").otherwise("partial")
    return s.select("fragments", F.round(F.coalesce(F.col("least"), F.lit(0.0)) * 100, 2).alias("pct"), kind.alias("coverage"))


def tiling_verdict(intervals: DataFrame, wanted: DataFrame) -> DataFrame:
    """Per wanted fragment PASS if its coverage is one range that holds the wanted one; no rows of it is FAIL."""
    c = coalesce_intervals(intervals).groupBy("fragment_id").agg(F.count("*").alias("ranges"), F.min("lo").alias("lo"), F.max("hi").alias("hi"))
    j = wanted.join(c, "fragment_id", "left")
    ok = (F.col("ranges") == 1) & (F.col("lo") <= F.col("want_lo")) & (F.col("hi") >= F.col("want_hi"))
    return j.select("fragment_id", F.coalesce("ranges", F.lit(0)).cast("long").alias("ranges"), F.when(F.coalesce(ok, F.lit(False)), "PASS").otherwise("FAIL").alias("verdict"))


# --- progress ------------------------------------------------------------------------------------------------------


def checkpoint_monotonic(series: DataFrame, by: str, order: str, value: str, span: int = SPAN) -> DataFrame:
    """Per series the first place where the value goes back, if any. ``order`` is a number: places are looked at in spans of
    ``span``; of the span before, its last value is enough."""
    own = series.select(by, order, value, F.floor(F.col(order) / span).alias("__span"))
    last = own.groupBy(by, "__span").agg(F.max_by(value, order).alias("__last"))
    last = last.withColumn("__carried", F.lag("__last").over(Window.partitionBy(by).orderBy("__span"))).drop("__last")
    w = Window.partitionBy(by, "__span").orderBy(order)
    rows = own.join(last, [by, "__span"]).withColumn("before", F.when(F.row_number().over(w) > 1, F.lag(value).over(w)).otherwise(F.col("__carried")))
    back = rows.where(F.col(value) < F.col("before"))
    first = back.groupBy(by).agg(F.min_by(F.struct(F.col(order).alias("at"), "before", F.col(value).alias("after")), order).alias("x"))
    return first.select(by, F.col("x.at").alias("at"), F.col("x.before").alias("before"), F.col("x.after").alias("after"))


def checkpoint_progress(chains: DataFrame, checkpoints: DataFrame, store: DataFrame) -> DataFrame:
    """Per chain the checkpoints' rows and greatest block; without rows (zero blocks are rows) the store's greatest."""
    c = checkpoints.groupBy("chain_id").agg(F.count("*").alias("n"), F.max("block_number").alias("m"))
    s = store.groupBy("chain_id").agg(F.max("block_number").alias("s"))
    j = chains.join(c, "chain_id", "left").join(s, "chain_id", "left")
    return j.select("chain_id", F.coalesce("n", F.lit(0)).cast("long").alias("n_rows"), F.when(F.coalesce("n", F.lit(0)) > 0, F.col("m")).otherwise(F.col("s")).alias("progress"))


def newest_row(blocks: DataFrame) -> DataFrame:
    """Per chain the number and the time of the same, newest row."""
    n = blocks.groupBy("chain_id").agg(F.max(F.struct("block_number", "block_ts")).alias("x"))
    return n.select("chain_id", F.col("x.block_number").alias("block_number"), F.col("x.block_ts").alias("block_ts"))


#: What a run of two legs is found to be.
FROZEN, GROWING, ONE_SIDED, UNRECOVERED = "frozen", "skew-growing", "one-sided-empty", "wedge-unrecovered"
IN_SKEW, ARMING, EMPTY_ARMING, BOTH_EMPTY = "both-populated-in-skew", "skew-above-threshold-arming", "empty-arming", "both-empty"
CATCHING_UP, LAGGING, QUIESCENT = "catching-up", "lagging-constant", "mutually-quiescent"


def progress_stagnation(series: DataFrame, by: list[str], order: str, a: str, b: str, at: str, threshold: int) -> DataFrame:
    """Two legs' newest times ``a`` and ``b`` (seconds; null: empty) per run at time ``at``, with ``state``, ``failing``,
    ``stale_side`` (A or B) and ``cause``, the state in which a failure that goes on began.

    A run by itself: both empty is no failure. One leg empty fails once it has been so for over ``threshold`` seconds and
    the other moves on. Apart by more than ``threshold``, legs fail if just one of them moves, or if they draw apart; a
    first such run only arms. Empty legs count with their last known time. A failure goes on, whatever the runs look
    like, until both legs are there and either near again, or the leg that stood still moves on and they don't draw apart.

    What a run is by itself comes from windows. Whether a failure goes on is a walk over the runs of a series that keeps
    one side and one cause: rows are sorted by series and streamed, so a long series needs no memory.
    """
    w = Window.partitionBy(*by).orderBy(order)
    upto, before = w.rowsBetween(Window.unboundedPreceding, 0), w.rowsBetween(Window.unboundedPreceding, -1)
    s = series.select(*by, order, F.col(a).alias("a"), F.col(b).alias("b"), F.col(at).alias("at"))
    for x in ("a", "b"):
        s = s.withColumn(f"{x}_now", F.last(x, ignorenulls=True).over(upto)).withColumn(f"{x}_then", F.last(x, ignorenulls=True).over(before))
        s = s.withColumn(f"{x}_seen", F.count(x).over(upto)).withColumn(f"{x}_moves", F.coalesce(F.col(f"{x}_now") > F.col(f"{x}_then"), F.lit(False)))
    known = F.col("a_now").isNotNull() | F.col("b_now").isNotNull()
    for x in ("a", "b"):  # a leg is empty since the first empty run after its last row, once any leg is known
        empty = Window.partitionBy(*by, f"{x}_seen")
        s = s.withColumn(f"{x}_empty_s", F.col("at") - F.min(F.when(F.col(x).isNull() & known, F.col("at"))).over(empty))
    gap, gap_then = F.abs(F.col("a_now") - F.col("b_now")), F.abs(F.col("a_then") - F.col("b_then"))
    s = s.withColumns({"skew": F.abs(F.col("a") - F.col("b")), "grew": F.coalesce(gap > gap_then, F.lit(False)), "shrank": F.coalesce(gap < gap_then, F.lit(False))})
    older = F.when(F.col("a_now") < F.col("b_now"), "A").when(F.col("b_now") < F.col("a_now"), "B")
    older_moves = F.when(older == "A", F.col("a_moves")).when(older == "B", F.col("b_moves")).otherwise(False)
    gone = F.when(F.col("a").isNull(), "A").otherwise("B")
    starved = F.when(gone == "A", (F.col("a_empty_s") > threshold) & F.col("b_moves")).otherwise((F.col("b_empty_s") > threshold) & F.col("a_moves"))
    alone = (
        F.when(F.col("a").isNull() & F.col("b").isNull(), BOTH_EMPTY)
        .when(F.col("skew").isNull(), F.when(F.coalesce(starved, F.lit(False)), ONE_SIDED).otherwise(EMPTY_ARMING))
        .when(F.col("skew") <= threshold, IN_SKEW)
        .when(F.col("a_then").isNull() | F.col("b_then").isNull(), ARMING)
        .when(F.col("a_moves") != F.col("b_moves"), FROZEN)
        .when(F.col("grew"), GROWING)
        .when(F.col("a_moves") & older_moves & F.col("shrank"), CATCHING_UP)
        .when(F.col("a_moves") & ~F.col("shrank"), LAGGING)
        .otherwise(QUIESCENT)
    )
    s = s.withColumn("state", alone)
    side = F.when(F.col("state") == ONE_SIDED, gone).when(F.col("state") == FROZEN, F.when(F.col("a_moves"), "B").otherwise("A")).when(F.col("state") == GROWING, older)
    near = F.coalesce(F.col("skew") <= threshold, F.lit(False))
    s = s.select(
        *by, order, "a", "b", "skew", "state", side.alias("stale_side"),
        *((near | (F.col("skew").isNotNull() & F.col(f"{x}_moves") & ~F.col("grew"))).alias(f"{x}_recovers") for x in ("a", "b")),
    )
    kept = [*by, order, "a", "b", "skew"]
    types = {f.name: f.dataType.simpleString() for f in s.schema}
    schema = ", ".join([*(f"`{c}` {types[c]}" for c in kept), "state string", "failing boolean", "stale_side string", "cause string"])

    def walk(batches):
        import pyarrow as pa

        key = side = cause = None
        for batch in batches:
            out = []
            columns = (batch.column(c).to_pylist() for c in ("state", "stale_side", "a_recovers", "b_recovers"))
            for own, state, stale, *recovers in zip(zip(*(batch.column(c).to_pylist() for c in by)), *columns):
                if own != key:
                    key, side, cause = own, None, None
                if cause is not None and not recovers["AB".index(side)]:
                    out.append((UNRECOVERED, True, side, cause))
                    continue
                failing = state in (FROZEN, GROWING, ONE_SIDED)
                side, cause = (stale, state) if failing else (None, None)
                out.append((state, failing, side, cause))
            states = [pa.array(c, t) for c, t in zip(zip(*out) if out else ((),) * 4, (pa.string(), pa.bool_(), pa.string(), pa.string()))]
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in kept), *states], [*kept, "state", "failing", "stale_side", "cause"])

    return s.repartition(*by).sortWithinPartitions(*by, order).mapInArrow(walk, schema)


# --- reorganisations -----------------------------------------------------------------------------------------------


def reorg_resolve(deliveries: DataFrame, by: tuple[str, ...] = (), span: int = 100_000) -> DataFrame:
    """Delivered headers (seq, number, hash, parent_hash) with ``orphaned``: a later delivery, repeats of a hash aside, is
    at its height or below.

    Deliveries are looked at in spans of ``span`` sequence numbers, so that a long chain is many tasks; of later spans the
    least height is enough. Windows run from the last delivery back, as frames that grow are kept up and frames that
    shrink are computed anew for each row.
    """
    first = deliveries.groupBy(*by, "hash").agg(F.min_by(F.struct("seq", "number", "parent_hash"), "seq").alias("x")).select(*by, "hash", "x.*")
    first = first.withColumn("span", F.floor(F.col("seq") / span))
    later = Window.partitionBy(*by, "span").orderBy(F.desc("seq")).rowsBetween(Window.unboundedPreceding, -1)
    spans = Window.partitionBy(*by).orderBy(F.desc("span")).rowsBetween(Window.unboundedPreceding, -1)  # one row a span
    least = first.groupBy(*by, "span").agg(F.min("number").alias("least")).withColumn("after", F.min("least").over(spans)).select(*by, "span", "after")
    own = first.withColumn("own", F.min("number").over(later)).join(least, [*by, "span"])
    orphaned = F.coalesce(F.least("own", "after") <= F.col("number"), F.lit(False))
    return own.select(*by, "seq", "number", "hash", "parent_hash", orphaned.alias("orphaned"))


def chain_linkage(headers: DataFrame, by: list[str], number: str, own: str, parent: str, span: int = 10_000) -> DataFrame:
    """Headers that break the chain: a number that doesn't rise, or a parent that isn't the header before.

    Headers are looked at in spans of ``span`` numbers, so that a long chain is many tasks; a span's first header is held
    against the last one of the spans before.
    """
    h = headers.select(*by, number, own, parent, F.floor(F.col(number) / span).alias("__span"))
    last = h.groupBy(*by, "__span").agg(F.max(F.struct(number, own)).alias("__x"))
    last = last.withColumn("__last", F.lag("__x").over(Window.partitionBy(*by).orderBy("__span"))).select(*by, "__span", "__last")  # one row a span
    w = Window.partitionBy(*by, "__span").orderBy(number, own)
    j = h.withColumn("__own", F.lag(F.struct(number, own)).over(w)).join(last, [*by, "__span"]).withColumn("__before", F.coalesce("__own", "__last"))
    kind = F.when(F.col(f"__before.{number}") >= F.col(number), "number").when(F.col(f"__before.{own}") != F.col(parent), "parent")
    return j.withColumn("violation", kind).where("violation IS NOT NULL").select(*by, number, own, "violation")


def finalized_prefix(headers: DataFrame, finalized: DataFrame) -> DataFrame:
    """Headers (chain_id, block_number, block_hash) with ``part``: final, tip (the highest final one) or remaining."""
    j = headers.join(finalized.select("chain_id", "finalized"), "chain_id")
    final = F.col("block_number") <= F.col("finalized")
    tips = j.where(final).groupBy("chain_id").agg(F.max("block_number").alias("tip"))
    j = j.join(tips, "chain_id", "left")
    part = F.when(F.col("block_number") == F.col("tip"), "tip").when(final, "final").otherwise("remaining")
    return j.select("chain_id", "block_number", "block_hash", part.alias("part"))


#: A checkpoint's fields, from the first that decides.
POSITION = ("block_ts", "chain_id", "block_number", "transaction_index", "event_type", "event_index")

# --- order, cuts, samples ------------------------------------------------------------------------------------------


def with_checkpoint(events: DataFrame, to: str = "checkpoint") -> DataFrame:
    """``events`` (block_ts, chain_id, block_number, transaction_index, event_type, event_index) with their checkpoint."""
    return events.withColumn(to, checkpoint_encode(**{c: F.col(c) for c in POSITION}))


def order_events(events: DataFrame) -> DataFrame:
    """Events in emit order: a range-partitioned sort by checkpoint. Whole numbers sort as the checkpoint's digits do, so they
    are what is shuffled and sorted, and its long text is made afterwards; what lacks a field has none and comes first."""
    if any(events.schema[c].dataType.simpleString() not in ("tinyint", "smallint", "int", "bigint") for c in POSITION):
        return with_checkpoint(events).orderBy("checkpoint")
    whole = reduce(lambda x, y: x & y, (F.col(c).isNotNull() for c in POSITION))
    return with_checkpoint(events.orderBy(whole, *POSITION))


def omnichain_ready(events: DataFrame, chains: DataFrame) -> DataFrame:
    """Events (chain_id, ts) with ``ready`` by the cross-chain cut: the least finalized time, at most the greatest end.

    ``chains``: chain_id, finalized_ts, end_ts (null: open). all_done: each chain's end is final and nothing is parked.
    """
    cut = chains.agg(
        F.min("finalized_ts").alias("f"),
        F.when(F.count_if(F.col("end_ts").isNull()) == 0, F.max("end_ts")).alias("e"),
        F.coalesce(F.bool_and(F.coalesce(F.col("end_ts") <= F.col("finalized_ts"), F.lit(False))), F.lit(False)).alias("ended"),
    ).select(F.least("f", "e").alias("cut"), "ended")
    j = events.crossJoin(F.broadcast(cut)).withColumn("ready", F.col("ts") <= F.col("cut"))
    parked = j.agg(F.count_if(~F.col("ready")).alias("parked"))
    return j.crossJoin(F.broadcast(parked)).select(*events.columns, "ready", (F.col("ended") & (F.col("parked") == 0)).alias("all_done"))


def bounded_sample(df: DataFrame, by: str, key: str, n: int = 5) -> DataFrame:
    """Per class its least ``n`` keys as text, least, greatest and count."""
    stats = df.groupBy(by).agg(F.min(key).alias("min_key"), F.max(key).alias("max_key"), F.count("*").alias("n"))
    distinct = df.select(by, key).distinct()
    ranked = distinct.withColumn("__r", F.row_number().over(Window.partitionBy(by).orderBy(key))).where(F.col("__r") <= n)
    keys = ranked.groupBy(by).agg(F.array_join(F.transform(F.array_sort(F.collect_list(key)), lambda x: x.cast("string")), ",").alias("sample"))
    return stats.join(keys, by)


def top_chains(df: DataFrame, by: list[str], k: int) -> DataFrame:
    """The ``k`` groups with most rows."""
    return df.groupBy(*by).agg(F.count("*").alias("n")).orderBy(F.desc("n"), *by).limit(k)


# --- sets ----------------------------------------------------------------------------------------------------------


def union_filters(parts: list[DataFrame], keys: list[str]) -> DataFrame:
    """The union of rows that several filters found, each key once."""
    return reduce(DataFrame.unionByName, parts).dropDuplicates(keys)


def set_diff(a: DataFrame, b: DataFrame) -> DataFrame:
    """Rows with ``side`` (only_a or only_b) and how many more that side has: multisets. One aggregation, no sort."""
    columns = a.columns
    both = a.withColumn("__d", F.lit(1)).unionByName(b.withColumn("__d", F.lit(-1)))
    d = both.groupBy(*columns).agg(F.sum("__d").alias("d")).where("d <> 0")
    return d.select(*columns, F.when(F.col("d") > 0, "only_a").otherwise("only_b").alias("side"), F.abs("d").alias("n"))


def referenced_keys(keys: DataFrame, logs: DataFrame, on: list[str]) -> DataFrame:
    """Keys that some log refers to."""
    return keys.select(*on).distinct().join(logs.select(*on), on, "left_semi")
