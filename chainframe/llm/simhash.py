"""SimHash near-dedup by a segment-popcount embedding.

A fingerprint's bits are cut into segments, and each segment's number of set bits is a coordinate. The Manhattan distance
of two such points is at most the Hamming distance of the fingerprints. The grid: coordinates are dealt to GROUPS groups;
fingerprints that differ in at most 3 bits differ in at most 3 groups, so they share the grid cell of some choice of the
other groups. Each distinct fingerprint goes to its cell for every choice, cells are joined with themselves in blocks of
bounded size, the Manhattan distance drops candidates, and the Hamming distance decides. A cell gives back a spanning
forest of its links, not its pairs, and components come from repeated large-star and small-star steps over that.
"""

from __future__ import annotations

import itertools
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from chainframe.llm.bpe import small
from chainframe.llm.common import free_name, materialize, text_of

BITS, DISTANCE, GROUPS, SEED = 64, 3, 6, 42
#: Points of a cell that one block holds; a cell with more is joined block by block.
BLOCK = 2048
_LOWER = bytes(range(256)).lower()

# --- fingerprints ---------------------------------------------------------------------------------------------


def fingerprint(text: str, width: int = 3) -> int:
    """Bit set where over half of the shingles' hashes have it; 0 without words."""
    import xxhash

    words = text.encode().translate(_LOWER).split()
    if not words:
        return 0
    joined = b" ".join(words)
    n = max(1, len(words) - width + 1)
    ends = list(itertools.accumulate(len(w) + 1 for w in words))
    starts = [0, *ends]
    digest = xxhash.xxh64_intdigest
    hashes = np.fromiter((digest(joined[starts[i] : ends[min(i + width, len(words)) - 1] - 1], SEED) for i in range(n)), np.uint64, n)
    counts = np.zeros(BITS, np.int64)
    for k in range(0, n, 4096):
        counts += np.unpackbits(hashes[k : k + 4096].view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int.from_bytes(np.packbits(2 * counts > n, bitorder="little").tobytes(), "little")


def signed(values: Iterable[int]) -> np.ndarray:
    return np.fromiter(values, np.uint64).view(np.int64)


def fingerprints(df: DataFrame, to: str = "fp") -> DataFrame:
    """Add ``to``, the fingerprint as a signed long; null texts are empty; other columns but text stay, one named ``to`` is
    replaced. Texts of any length are hashed whole, a very long one by itself."""
    kept = [c for c in df.columns if c not in (to, "text")]
    name = free_name(df, "__text")
    plain = df.select(*(F.col(f"`{c}`") for c in kept), text_of("text").alias(name))

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for one in small(batch, name, 1_000_000):
                own = signed(fingerprint(t) for t in one.column(name).to_pylist())
                yield pa.RecordBatch.from_arrays([*(one.column(c) for c in kept), pa.array(own)], [*kept, to])

    return plain.mapInArrow(run, plain.drop(name).schema.add(to, "long"))


# --- embedding and grid ---------------------------------------------------------------------------------------

EVEN = 0x5555555555555555


def as_long(value: int) -> int:
    return value - (1 << 64) if value >> 63 else value


def group_masks(groups: int = GROUPS) -> list[int]:
    """Segments of two bits, dealt to groups in turn; the mask of each group's segments."""
    return [sum(0b11 << 2 * s for s in range(BITS // 2) if s % groups == g) for g in range(groups)]


def embedding(fp: Column) -> Column:
    """The bit counts of the segments, each as a thermometer (0 -> 00, 1 -> 01, 2 -> 11), so that the Manhattan distance
    of two embeddings is the number of their differing bits."""
    shifted = F.shiftrightunsigned(fp, 1)
    some, both = fp.bitwiseOR(shifted), fp.bitwiseAND(shifted)
    return some.bitwiseAND(F.lit(EVEN)).bitwiseOR(F.shiftleft(both.bitwiseAND(F.lit(EVEN)), 1))


def cells(points: DataFrame) -> DataFrame:
    """(fp, emb, choice, cell): each distinct fingerprint in its cell for every choice of GROUPS - DISTANCE groups."""
    masks = group_masks()
    choices = [as_long(sum(masks[g] for g in own)) for own in itertools.combinations(range(GROUPS), GROUPS - DISTANCE)]
    own = F.array(*(F.struct(F.lit(k).alias("choice"), F.col("emb").bitwiseAND(F.lit(m).cast("long")).alias("cell")) for k, m in enumerate(choices)))
    return points.select("fp", embedding(F.col("fp")).alias("emb")).select("fp", "emb", F.inline(own))


def blocks(celled: DataFrame, block: int = BLOCK) -> DataFrame:
    """(choice, cell, a, b, part, fp, emb): cells of more than ``block`` points meet as pairs a <= b of their parts."""
    large = celled.groupBy("choice", "cell").agg(F.count("*").alias("n")).where(F.col("n") > block)
    parts = F.ceil(F.col("n") / block).cast("int")
    own = celled.join(large, ["choice", "cell"], "left").withColumn("parts", F.coalesce(parts, F.lit(1)))
    own = own.withColumn("part", F.pmod(F.xxhash64("fp"), F.col("parts")).cast("int"))
    other = F.explode(F.sequence(F.lit(0), F.col("parts") - 1))
    return own.select("choice", "cell", "part", "fp", "emb", other.alias("other")).select(
        "choice", "cell", F.least("part", "other").alias("a"), F.greatest("part", "other").alias("b"), "part", "fp", "emb"
    )


def forest(fp: np.ndarray, emb: np.ndarray, part: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Star edges (member, centre) of the components of the points' links; the centre is the component's first point.

    With two parts only links between them count: those within one are found in the part's own block.
    """
    n = len(fp)
    label = np.arange(n)
    two = part[0] != part[-1] or bool((part != part[0]).any())
    while True:
        before = label.copy()
        for k in range(0, n, 256):
            rows = slice(k, k + 256)
            near = np.bitwise_count(emb[rows, None] ^ emb[None, :]) <= DISTANCE
            i, j = np.nonzero(near)
            i += k
            exact = np.bitwise_count(fp[i] ^ fp[j]) <= DISTANCE
            if two:
                exact &= part[i] != part[j]
            i, j = i[exact], j[exact]
            low = np.minimum(label[i], label[j])
            np.minimum.at(label, i, low)
            np.minimum.at(label, j, low)
        while (jump := label[label] != label).any():
            label[jump] = label[label[jump]]
        if (label == before).all():
            break
    member = np.flatnonzero(label != np.arange(n))
    yield fp[member], fp[label[member]]


def links(points: DataFrame, block: int = BLOCK) -> DataFrame:
    """(src, dst): edges whose components are those of all links between distinct fingerprints in ``points`` (fp)."""
    keys = ["choice", "cell", "a", "b"]
    dealt = blocks(materialize(cells(points)), block).repartition(*keys).sortWithinPartitions(*keys)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = None
        for batch in itertools.chain(batches, [None]):
            now = None if batch is None else np.stack([batch.column(c).to_numpy().astype(np.int64) for c in (*keys, "part", "fp", "emb")])
            both = [x for x in (held, now) if x is not None]
            if not both:
                return
            rows = np.concatenate(both, axis=1)
            if now is None:
                whole, held = rows, None
            else:  # the last cell may go on in the next batch
                same = (rows[:4] == rows[:4, -1:]).all(axis=0)
                first = int(np.flatnonzero(~same)[-1]) + 1 if not same.all() else 0
                whole, held = rows[:, :first], rows[:, first:]
            src, dst = [np.empty(0, np.uint64)], [np.empty(0, np.uint64)]
            if whole.shape[1]:
                change = np.flatnonzero((whole[:4, 1:] != whole[:4, :-1]).any(axis=0)) + 1
                starts, ends = np.r_[0, change], np.r_[change, whole.shape[1]]
                fp, emb = whole[5].view(np.uint64), whole[6].view(np.uint64)
                sizes = ends - starts
                two = starts[sizes == 2]  # most cells with company have two points
                ok = (np.bitwise_count(emb[two] ^ emb[two + 1]) <= DISTANCE) & (np.bitwise_count(fp[two] ^ fp[two + 1]) <= DISTANCE)
                src.append(fp[two + 1][ok])
                dst.append(fp[two][ok])
                for a, b in zip(starts[sizes > 2].tolist(), ends[sizes > 2].tolist()):
                    for s, d in forest(fp[a:b], emb[a:b], whole[4, a:b]):
                        src.append(s)
                        dst.append(d)
            s, d = np.concatenate(src).view(np.int64), np.concatenate(dst).view(np.int64)
            low, high = np.minimum(s, d), np.maximum(s, d)
            found = np.unique(np.stack([high, low]), axis=1)
            yield pa.RecordBatch.from_arrays([pa.array(found[0]), pa.array(found[1])], ["src", "dst"])

    return dealt.mapInArrow(run, "src long, dst long").distinct()


# --- components -----------------------------------------------------------------------------------------------


def components(edges: DataFrame, most_rounds: int = 60) -> DataFrame:
    """(node, root): the least node of each edge's component, for nodes that have edges.

    Alternates large-star and small-star until nothing changes. Every round is a table in the shared folder; least
    neighbours are pre-aggregated, and joined as plain tables, so that a hub's rows can be split.
    """
    now = materialize(edges.select(F.greatest("src", "dst").alias("u"), F.least("src", "dst").alias("v")).where("u > v").distinct())
    state = None
    for _ in range(most_rounds):
        both = now.unionByName(now.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = materialize(both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m")))
        large = both.where("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        large = materialize(large.where("u > v").distinct())
        least = materialize(large.groupBy("u").agg(F.min("v").alias("m")))
        small_star = large.join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u > v")
        now = materialize(small_star.unionByName(least.select("u", F.col("m").alias("v"))).distinct())
        after = now.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if after == state:
            return now.select(F.col("u").alias("node"), F.col("v").alias("root"))
        state = after
    raise RuntimeError(f"components did not settle in {most_rounds} rounds")


def near_duplicates(df: DataFrame, carry: tuple[str, ...] = ()) -> DataFrame:
    """doc_id, fp, component_id, root per row of ``df`` (doc_id, text and what is to be carried along; other columns are
    ignored, whatever their names). ``root`` is a fingerprint that stands for the component.

    component_id is the smallest doc_id that links reach; null doc_ids don't count, and a component of such rows alone
    has none. Null texts are empty; texts without words have fingerprint 0. Texts of any length are hashed whole. Repeated
    rows come back each, in the same component; equal fingerprints are one point, so ties don't matter. An empty table
    gives no rows.
    """
    rows = materialize(fingerprints(df.select("doc_id", "text", *carry)))
    points = materialize(rows.groupBy("fp").agg(F.min("doc_id").alias("least_id")))
    roots = components(links(points.select("fp")))
    rooted = materialize(
        points.join(roots, points["fp"] == roots["node"], "left").select("fp", "least_id", F.coalesce("root", "fp").alias("root"))
    )
    ids = materialize(rooted.groupBy("root").agg(F.min("least_id").alias("component_id")))
    classes = materialize(rooted.join(ids, "root").select("fp", "component_id", "root"))
    return rows.join(classes, "fp").select("doc_id", *carry, "fp", "component_id", "root")


def near_duplicate_classes(documents: DataFrame) -> DataFrame:
    found = near_duplicates(documents)
    return found.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")
