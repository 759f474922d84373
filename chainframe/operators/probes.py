"""A bitmap over the hashes of keys, made in Spark and used inside expressions: what surely has no such key goes before it
is shuffled to a join. It has a fixed number of bits, so what is sent doesn't grow with the keys; what it lets through
wrongly, the join drops."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Half a megabyte; with a million keys about one other key in seven gets through.
BITS = 1 << 22


def key_hash(chain: str, key: str) -> str:
    """SQL of a key's hash."""
    return f"xxhash64(CAST({chain} AS BIGINT), {key})"


def bitmap(keys: DataFrame, bits: int = BITS) -> DataFrame:
    """One row with ``words``, bits / 64 numbers, for the hashes in ``keys`` (h): two bits are set for each."""
    spark = keys.sparkSession
    place = F.explode(F.array(F.pmod("h", F.lit(bits)), F.pmod(F.shiftrightunsigned("h", 32), F.lit(bits))))
    own = keys.select(place.alias("place")).groupBy((F.col("place") / 64).cast("int").alias("id")).agg(F.bit_or(F.expr("shiftleft(1L, int(place % 64))")).alias("set"))
    whole = spark.range(bits // 64).join(own, "id", "left").select(F.struct("id", F.coalesce("set", F.lit(0)).alias("set")).alias("w"))
    return whole.agg(F.transform(F.sort_array(F.collect_list("w")), lambda w: w["set"]).alias("words"))  # always bits / 64 rows


def seen(name: str, h: str, bits: int = BITS) -> str:
    """SQL: whether the bitmap in the one-row table ``{name}`` may have the hash ``h``."""
    at = lambda place: f"(shiftrightunsigned(get((SELECT words FROM {{{name}}}), CAST(({place}) DIV 64 AS INT)), CAST(({place}) % 64 AS INT)) & 1L) = 1L"
    return f"({at(f'pmod({h}, {bits})')} AND {at(f'pmod(shiftrightunsigned({h}, 32), {bits})')})"
