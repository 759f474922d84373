"""Packing of documents into sequences of bounded length.

Documents are cut into full sequences and a rest. Rests are packed by first-fit decreasing, independently in randomised
groups of documents; a tournament tree over the bins' free places finds the first bin that fits in logarithmic time.
Only lengths and checksums are shuffled, never ids or texts.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from chainframe.llm import bpe
from chainframe.llm.common import materialize, text_of


class FirstFit:
    """A tournament tree: each inner node holds the larger free space of its two children, leaves are bins in order."""

    def __init__(self, bins: int, capacity: int):
        self.leaves = 1 << max(0, (bins - 1).bit_length())
        self.free = np.full(2 * self.leaves, capacity, np.int64).tolist()

    def place(self, length: int) -> tuple[int, int]:
        """(first bin with room, what it still has); there are as many bins as items, so one always fits."""
        free, node = self.free, 1
        while node < self.leaves:
            node *= 2
            if free[node] < length:
                node += 1
        free[node] -= length
        left, at = free[node], node
        while node > 1:
            node >>= 1
            free[node] = max(free[2 * node], free[2 * node + 1])
        return at - self.leaves, left


def first_fit_decreasing(lengths: np.ndarray, capacity: int) -> np.ndarray:
    """The bin of each item. Ties go in the order of the items."""
    bins = np.empty(len(lengths), np.int64)
    tree = FirstFit(max(1, len(lengths)), capacity)
    for i in np.argsort(-lengths, kind="stable").tolist():
        bins[i], _ = tree.place(int(lengths[i]))
    return bins


def padded_to(filled: int, capacity: int) -> int:
    """A sequence's length with padding: none at a power of two, otherwise up to the capacity."""
    return filled if filled & (filled - 1) == 0 else capacity


def pieces_of(doc_tokens: int, capacity: int) -> list[tuple[int, int]]:
    """(start, length): full sequences and the rest, if any."""
    return [(s, min(capacity, doc_tokens - s)) for s in range(0, doc_tokens, capacity)]


def tokenized_pieces(docs: DataFrame, path: str, end_id: int, capacity: int) -> DataFrame:
    """One row per document with its pieces: doc_id, doc_tokens, and start, length, ids_crc32 as lists. Ids are made and
    summed up in one pass; they never leave the worker."""
    content = bpe.vocabulary(docs, path)
    schema = "doc_id long, doc_tokens long, start array<long>, length array<long>, ids_crc32 array<long>"

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last = np.array([end_id], "<u4").tobytes()
        for batch in batches:
            for one in bpe.small(batch, "text"):
                tokens, starts, lengths, sums = [], [], [], []
                for ids, _ in bpe.encode_texts(one.column("text").to_pylist(), content.value, special=True):
                    own = ids + last
                    cut = pieces_of(len(own) // 4, capacity)
                    tokens.append(len(own) // 4)
                    starts.append([s for s, _ in cut])
                    lengths.append([n for _, n in cut])
                    sums.append([zlib.crc32(own[4 * s : 4 * (s + n)]) for s, n in cut])
                lists = [pa.array(x, pa.list_(pa.int64())) for x in (starts, lengths, sums)]
                yield pa.RecordBatch.from_arrays([one.column("doc_id"), pa.array(tokens, pa.int64()), *lists], ["doc_id", "doc_tokens", "start", "length", "ids_crc32"])

    return docs.select(F.col("doc_id").cast("long"), text_of("text").alias("text")).mapInArrow(run, schema)


def pack(docs: DataFrame, path: str, end_id: int = 1, capacity: int = 2048, group_docs: int = 4096, seed: int = 7) -> DataFrame:
    """Pack all rows of ``docs`` (doc_id, text; other columns are ignored).

    Null texts are empty; an empty text still has ``end_id``. Returns a row per piece: doc_id, start, length, ids_crc32,
    doc_tokens, sequence_id, offset, padding (that of the sequence). Each id lies in exactly one piece; a sequence's
    pieces lie in it without gaps. Repeated rows are packed each on their own; null doc_ids are kept. An empty table
    gives no rows. ``group_docs`` is the mean number of documents in a group: groups are formed at random by a hash of
    the row, so that neither a hot key nor a group of copies makes one larger, and their number grows with the table.
    """
    # written once: a task that runs again after a loss must find the same rows in the same groups
    pieces = materialize(tokenized_pieces(docs, path, end_id, capacity).withColumn("row", F.monotonically_increasing_id()))
    groups = max(1, -(-pieces.count() // group_docs))
    pieces = pieces.withColumn("grp", F.pmod(F.xxhash64(F.lit(seed), "doc_id", "row"), F.lit(groups))).drop("row")
    schema = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long, padding long"

    def run(group: pa.Table) -> pa.Table:
        return pack_group(group, capacity)

    return pieces.groupBy("grp").applyInArrow(run, schema)


def pack_group(group: pa.Table, capacity: int) -> pa.Table:
    """Sequences of one group. Sequence ids are the group's number times 2^32, plus a count."""
    lists = {c: group.column(c).combine_chunks() for c in ("start", "length", "ids_crc32")}
    parent = pc.list_parent_indices(lists["start"])
    rows = pa.table({c: x.flatten() for c, x in lists.items()} | {c: group.column(c).take(parent) for c in ("doc_id", "doc_tokens")})
    # the order of arrival must not matter: a task that runs again makes the same sequences
    rows = rows.take(pc.sort_indices(rows, [(c, "ascending") for c in ("doc_id", "ids_crc32", "start", "length")]))
    length = rows.column("length").to_numpy()
    bins = first_fit_decreasing(length, capacity)
    order = np.lexsort((-length, bins))
    rows, length, bins = rows.take(order), length[order], bins[order]
    filled = np.bincount(bins, length).astype(np.int64)
    before = np.cumsum(length) - length
    offset = before - before[np.searchsorted(bins, bins)]
    padding = np.array([padded_to(n, capacity) - n for n in filled.tolist()], np.int64)[bins]
    sequence = group.column("grp")[0].as_py() * 2**32 + bins
    new = {"sequence_id": sequence, "offset": offset, "padding": padding}
    return pa.table({c: rows.column(c) for c in ("doc_id", "start", "length", "ids_crc32", "doc_tokens")} | new)
